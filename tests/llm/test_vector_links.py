import numpy as np
import pytest
from pyspark.sql import functions as F

from tapekeeper.llm import vector_links
from tapekeeper.llm.queries import op7_vector_links


def brute(rows, threshold=0.95):
    """{position: (n_links, component)} by comparing all vectors."""
    def sound(i, v):
        return i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [k for k, (i, v) in enumerate(rows) if sound(i, v)]
    unit = {k: np.array(rows[k][1], np.float64) / np.linalg.norm(np.array(rows[k][1], np.float64)) for k in good}
    near = {k: [j for j in good if j != k and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= threshold] for k in good}
    label = {k: rows[k][0] for k in good}
    changed = True
    while changed:
        changed = False
        for k in good:
            low = min([label[j] for j in near[k]] + [label[k]])
            if low < label[k]:
                label[k], changed = low, True
    return [(i, len(near.get(k, ())), label.get(k, i)) for k, (i, _) in enumerate(rows)]


def clustered(seed, n=400, size=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, size))
    out = []
    for i in range(n):
        v = centres[i % 20] + rng.normal(size=size) * rng.choice([0.02, 0.2, 0.3, 1.5])
        out.append((1000 - i, (v / np.linalg.norm(v) * rng.uniform(0.5, 2)).astype(np.float32).tolist()))
    return out + [(5000 + k, out[7][1]) for k in range(30)]


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, n_links int, node string")
    return sorted(((r.id, r.n_links, r.component_id) for r in vector_links.link_vectors(df.repartition(3), 0.95, **options).collect()), key=str)


def test_clusters_against_brute_force(spark):
    rows = clustered(1)
    assert max(n for _, n, _ in brute(rows)) > 30
    assert found(spark, rows) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("options", [dict(blocks=1), dict(blocks=8), dict(blocks=16), dict(blocks=100)])
def test_other_blocks_find_the_same(spark, options):
    rows = clustered(2, 150)
    assert found(spark, rows, **options) == sorted(brute(rows), key=str)


def test_sides_of_a_full_cell(spark, monkeypatch):
    monkeypatch.setattr(vector_links, "HOME", 10)
    monkeypatch.setattr(vector_links, "LOOK_IN", 25)
    rows = clustered(3, 200)
    assert found(spark, rows) == sorted(brute(rows), key=str)


def test_a_large_group_of_near_copies_is_counted_without_its_pairs(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=64)
    rows = [(i, (base + 0.02 * rng.normal(size=64)).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(2000 + i, rng.normal(size=64).astype(np.float32).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = {r.id: r for r in vector_links.link_vectors(df, 0.95).collect()}
    assert all(out[i].n_links == 1499 and out[i].component_id == 0 for i in range(1500))
    assert all(out[i].n_links == 0 for i in range(2000, 2300))
    classes = df.select(F.col("vec_id").alias("node"), F.lit(1).cast("long").alias("n"), F.col("embedding").alias("vector"))
    assert vector_links.linked(classes, 0.95, 4).count() < 4 * 1500 * 4


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]),
            (7, [1.0, 0.0]), (8, [2.0, 0.1]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e-30, 0.0]), (7, [-1.0, 0.0])]
    assert found(spark, rows) == sorted(brute(rows), key=str)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_links.link_vectors(empty).count() == 0


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    out = op7_vector_links(spark, sf).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == sorted(brute(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
