import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from tapekeeper.llm import lexical

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("term", T.StringType()),
                     T.StructField("score", T.LongType()), T.StructField("item_id", T.LongType())])
ITEMS = "item_id bigint, text string, rank string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow(docs, items, k):
    counted = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in counted:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
                        for t in terms if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def corpus(n, seed):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeXYZ0éñ中😀") for _ in range(rnd.randint(1, 4))) for _ in range(60)]
    text = lambda most: "".join(rnd.choice(vocabulary) + rnd.choice([" ", ", ", "\n", "-", "_", "\x7f", "'"]) for _ in range(rnd.randint(0, most)))
    return [(i, text(60)) for i in range(n)], [(i, text(12)) for i in range(25)]


def found(spark, docs, items, k=50):
    df = lexical.rank_documents(spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], DOCS),
                                spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS), k)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_brute_force_with_odd_rows(spark):
    docs, items = corpus(300, 1)
    docs += [(None, "aa bb ab"), (None, "aa bb ab"), (5, "ab aa"), (901, None), (902, ""), (903, " ,;"), (904, "aa " * 30000)]
    docs += [(2000 + i, docs[0][1]) for i in range(150)]
    items += [(None, "aa"), (3, "ab bb"), (70, None), (71, ""), (72, "nowhere"), (73, "AA aA")]
    assert found(spark, docs, items, 20) == slow(docs, items, 20)


@pytest.mark.parametrize("limits", [{"BLOCK_ITEMS": 4}, {"BLOCK_BYTES": 60}, {"CELLS": 30}])
def test_blocks_and_pieces_do_not_matter(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(lexical, name, value)
    docs, items = corpus(120, 2)
    assert found(spark, docs, items, 5) == slow(docs, items, 5)


def test_no_documents_and_no_items(spark):
    assert found(spark, [], [(1, "a")]) == [] == found(spark, [(1, "a")], []) == found(spark, [(1, "a")], [(1, None)])


def test_terms_only_match_whole_words():
    hits = [n for _, n in lexical.automaton(["a", "ab", "b"]).iter(" a ab a b bab ")]
    assert hits == [0, 1, 0, 2]


def test_best_keeps_ties_by_id_over_many_additions():
    best = lexical.Best(1, 3)
    for i in range(9000, 0, -1):
        best.add(np.array([[7]]), np.array([i]), np.array([False]))
    best.add(np.array([[7], [8]]), np.array([0, 0]), np.array([True, True]))
    item, score, unnamed, ids = best.cut()
    assert score.tolist() == [8, 7, 7] and ids.tolist() == [0, 1, 2] and unnamed.tolist() == [True, False, False]


def test_lengths_do_not_overflow():
    assert lexical.lengths(np.array([10**9]), 10**12, 10**13).tolist() == [50 + 50 * 10**21 // 10**13]


def test_sums_beyond_doubles_are_exact():
    place, values = np.array([0, 0, 1]), np.array([1 << 60, 1, 3])
    assert lexical._summed(place, values, 2, False).tolist() == [(1 << 60) + 1, 3]
