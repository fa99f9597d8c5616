import random

import numpy as np
import pytest

from tapekeeper.llm import toxicity
from tapekeeper.llm.queries import REJECTED_SEVERITY, table, toxicity_model
from tapekeeper.llm.training import Example


def text_rows(n, seed):
    rng, words = random.Random(seed), [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    for _ in range(n):
        grade = rng.choice([0, 0, 0, 1, 2])
        bad = {0: [], 1: ["mildly"], 2: ["mildly", "grossly"]}[grade]
        yield " ".join(rng.choices(words, k=rng.randint(5, 60)) + bad), grade


def fit(rows):
    of = toxicity.word_presence()
    made = [Example(g, *of(t)) for t, g in rows]
    grades = np.array([g for _, g in rows])
    places = toxicity.telling_places(made, grades > 0)
    return toxicity.fit_severity(made, places, grades)


def test_three_grades_are_told_apart_and_thresholds_are_ordered(spark):
    model = fit(list(text_rows(1500, 1)))
    assert len(model.thresholds) == 2 and model.thresholds[0] <= model.thresholds[1]
    unseen = list(text_rows(300, 2))
    docs = spark.createDataFrame([(i, t, 0) for i, (t, _) in enumerate(unseen)], "doc_id long, text string, severity int")
    rows = toxicity.score_severity(docs, model).collect()
    for r in rows:
        assert r.grade == unseen[r.id][1]
        assert abs(r.severity - sum(r.above)) < 1e-9 and r.above[0] >= r.above[1]


def test_gradient_maximises_the_likelihood():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (4000, 3))
    true_w, true_t = np.array([2.0, -1.0, 0.0]), np.array([0.5, 2.0])
    noise = np.log(1 / rng.uniform(size=4000) - 1)
    grades = ((x @ true_w + noise)[:, None] > true_t).sum(axis=1)
    rows = [Example(0, np.nonzero(r)[0], np.ones(r.sum())) for r in x]
    model = toxicity.fit_severity(rows, np.arange(3), grades, penalty=0.0, steps=1500, rate=0.05)
    assert np.allclose(model.weights, true_w, atol=0.25) and np.allclose(model.thresholds, true_t, atol=0.25)


def test_edge_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (2, "word " * 100_000, "c"), (2, "word", "c")],
                                 "doc_id long, text string, row string")
    for rows in ([], [("only", 0)] * 5, [("x y", 1)] * 3):
        model = fit(rows)
        scored = toxicity.score_severity(docs, model, keep=("doc_id", "row")).collect()
        assert len(scored) == 4 and len({r.severity for r in scored}) == 1
        assert all(np.isfinite(r.severity) and r.row.doc_id == r.id for r in scored)
    assert toxicity.score_severity(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("taught, clean, recall", [(35, 3400, 0.45), (300, 3000, 0.8)])
def test_unseen_toxic_rows_are_found(spark, tmp_path, taught, clean, recall):
    """Of the labelled rows of a table some are shown, one in 100 or in 11 toxic; of the others most toxic and hardly any clean ones go."""
    sf = "/root/testdata/sf0.1"
    labels = sorted(tuple(r) for r in table(spark, sf, "labels").filter("toxic is not null").select("doc_id", "toxic").collect())
    toxic, fine = [d for d, t in labels if t], [d for d, t in labels if not t]
    shown = [(d, None, 1) for d in toxic[:taught]] + [(d, None, 0) for d in fine[:clean]]
    spark.createDataFrame(shown, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark, sf, "documents").join(spark.createDataFrame([(d,) for d, _ in labels], "doc_id long"), "doc_id")
    model = toxicity_model(spark, docs, str(tmp_path))
    gone = {r.id for r in toxicity.score_severity(docs, model).filter(f"severity >= {REJECTED_SEVERITY}").collect()}
    assert len(gone & set(toxic[taught:])) >= recall * len(toxic[taught:])
    assert len(gone & set(fine[clean:])) <= 0.02 * len(fine[clean:])


def test_model_without_labels(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    model = toxicity_model(spark, docs, str(tmp_path))
    assert len(model.places) == 0 and toxicity.score_severity(docs, model).count() == 1
