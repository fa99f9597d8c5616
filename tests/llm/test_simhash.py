import random
import re

import numpy as np
import xxhash

from tapekeeper.llm import simhash
from tapekeeper.llm.queries import op8_simhash


def plain_fingerprint(text, k=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    """{id: smallest reachable id} by comparing every two distinct fingerprints."""
    first = {}
    for i, f in prints:
        first[f] = min(first.get(f, i), i)
    values = np.array(sorted(first), np.uint64)
    label = {int(v): first[int(v)] for v in values}
    near = {int(v): values[np.bitwise_count(values ^ v) <= radius].tolist() for v in values}
    changed = True
    while changed:
        changed = False
        for v, others in near.items():
            low = min(label[o] for o in others)
            if low < label[v]:
                label[v], changed = low, True
    return {i: label[f] for i, f in prints}


def test_fingerprint_of_odd_texts():
    words = random.Random(1)
    for text in ["", " \t\n", "one", "two words", "A b c D\x1ce f", "É É é é É", "x " * 40_000,
                 " ".join(str(words.random()) for _ in range(20_000))]:
        assert simhash.text_fingerprint(text, 4) == plain_fingerprint(text), text[:20]


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(3)
    masks = simhash.covering_masks(4)
    assert len(masks) == 31
    for _ in range(5000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
        assert any(mask & diff == 0 for mask in masks)


def links_of(spark, values, radius=4):
    df = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    return simhash.fingerprint_links(df, radius)


def test_a_bucket_of_many_sides_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SIDE", 50)
    rng = random.Random(5)
    base = rng.getrandbits(63)
    values = {base}
    while len(values) < 600:  # a long chain of close fingerprints, and noise
        values.add(rng.choice(sorted(values)) ^ (1 << rng.randrange(62)) ^ (1 << rng.randrange(62)))
    values |= {rng.getrandbits(63) for _ in range(200)}
    links = [(r.a, r.b) for r in links_of(spark, values).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    expected = brute_components([(v, v) for v in values], 4)
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {v: root(v) for v in values} == expected


def test_query(spark, sf):
    rows = op8_simhash(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = [(d.doc_id, plain_fingerprint(d.text)) for d in docs]
    assert {r.doc_id: int(r.fingerprint, 16) for r in rows} == dict(prints) and len(rows) == len(prints)
    assert {r.doc_id: r.component_id for r in rows} == brute_components(prints, 4)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b c d e"), (4, "A  B c\nd e"), (4, "a b c d e"), (5, "other words here now"), (None, "a b c d e")]
    docs = spark.createDataFrame([(i, t, 0, "z") for i, t in rows], "doc_id long, text string, fingerprint int, id string").repartition(3)
    found = {(r.id, r.component_id) for r in simhash.group_near_copies(docs, 4, 4).collect()}
    assert found == {(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (None, 3)}
    kept = simhash.drop_near_copies(docs, 4, 4)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 5]
    assert simhash.group_near_copies(docs.limit(0), 4, 4).count() == 0


def kept_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(3)
    return sorted((r.n for r in simhash.drop_near_copies(docs, 4, 4).collect()))


def test_null_ids_lose_only_in_their_own_group(spark):
    rows = [(1, "a b c d e", 0), (None, "a b c d e", 1), (None, "quite another text of words", 2),
            (None, "the third text has no id", 3), (None, "the third text has no id", 3), (None, "", 4), (7, None, 5)]
    assert kept_rows(spark, rows) == [0, 2, 3, 5]


def test_a_repeated_id_wins_and_loses_by_group(spark):
    rows = [(4, "a b c d e", 0), (9, "a b c d e", 1), (3, "quite another text of words", 2), (4, "quite another text of words", 3),
            (4, "A B C D E", 4), (5, "the third text has one id", 6), (5, "the third text has one id", 6)]
    for turned in (rows, rows[::-1]):
        kept = kept_rows(spark, turned)
        assert len(kept) == 3 and {2, 6} < set(kept) and {0, 4} & set(kept)
    assert kept_rows(spark, rows) == kept_rows(spark, rows[::-1])
