import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from tapekeeper.llm import infill

KINDS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n", T.StringType()),
                      T.StructField("form", T.StringType()), T.StructField("output", T.StringType())])


def slow(doc_id, text, seed=1):
    """The contract, character by character."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    if n == 0 or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "<P>" + text[:a], "<M>" + text[a:b], "<S>" + text[b:]
    return (n, "spm", a, b - a, s + p + m) if h4 % 100 < 20 else (n, "psm", a, b - a, p + s + m)


def texts():
    rnd = random.Random(3)
    letters = "ab <>PSM\n" + "éßñ" + "中文" + "😀"
    passage = "".join(rnd.choice(letters.replace("<", "")) for _ in range(3000))
    odd = ["", None, "x", "😀", "a<P>b", "<S>", "y" * 63 + "<M>" + "z" * 70, "<" * 5000, "é" * 9001, "<P" * 400, "S>" * 400]
    mixed = ["".join(rnd.choice(letters) for _ in range(rnd.choice((1, 5, 60, 70, 300, 5000)))) for _ in range(150)]
    shared = [f"{i} " + passage + " " * i + passage[::-1] for i in range(40)]
    split = ["q" * i + "<M>" + "r" * 200 for i in range(55, 75)]
    return odd + mixed + shared + split


def test_equals_the_slow_form_and_restores(spark):
    rows = [(i, t, "n", "form", "output") for i, t in enumerate(texts())] + [(None, "no id", "", "", ""), (7, "twice", "", "", "")]
    made = infill.fill_in_middle(spark.createDataFrame(rows, KINDS)).withColumn(
        "back", infill.restored(F.col("form"), F.col("output"))).collect()
    assert len(made) == len(rows)
    for (doc_id, text, *_), row in zip(rows, made):
        assert (row.id, *row[1:6]) == (doc_id, *slow(doc_id, text))
        assert row.back == (text or "")
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_seed_and_shares(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("some words to cut").alias("text"))
    never = infill.fill_in_middle(docs, seed=5, plain_percent=0, spm_percent=100)
    assert {r.form for r in never.select("form").distinct().collect()} == {"spm"}
    shares = {r.form: r["count"] / 2000 for r in infill.fill_in_middle(docs).groupBy("form").count().collect()}
    assert abs(shares["plain"] - 0.1) < 0.03 and abs(shares["spm"] - 0.18) < 0.03


def test_no_rows(spark):
    assert infill.fill_in_middle(spark.createDataFrame([], KINDS)).collect() == []


def test_break_points_do_not_depend_on_what_stands_before():
    data = np.random.default_rng(1).integers(0, 256, 20000).astype(np.uint8)
    alone = set(infill.break_points(data[5000:]).tolist())
    assert {b - 5000 for b in infill.break_points(data).tolist() if b > 5000 + 31} == {b for b in alone if b > 31}


def test_pieces_hashed_one_after_the_other_give_the_same_breaks(monkeypatch):
    data = np.random.default_rng(2).integers(0, 256, 50000).astype(np.uint8)
    whole = infill.break_points(data).tolist()
    monkeypatch.setattr(infill, "STEP", 777)
    assert infill.break_points(data).tolist() == whole and len(whole) > 100


def test_chunks_are_bounded_and_shared_chunks_are_counted_once():
    text = bytes(np.random.default_rng(4).integers(97, 123, 100_000).astype(np.uint8))
    known = infill.Summaries((b"<P>",))
    for lead in (b"", b"one", b"seventeen more words"):
        breaks = infill.break_points(np.frombuffer(lead + text, np.uint8)).tolist()
        ends = infill.chunk_ends(breaks, 0, len(lead + text))
        sizes = np.diff([0, *ends])
        assert ends[-1] == len(lead + text) and sizes.max() <= infill.MOST and sizes[:-1].min() >= infill.LEAST
        infill.ChunkedText(lead + text, ends, known)
    assert len(known) < 1.2 * len(ends)


@pytest.mark.parametrize("text", [b"\x80\x80abc", b"ab\xc3"])
def test_bytes_that_are_no_text_keep_their_place(text):
    whole = infill.ChunkedText(text, [len(text)], infill.Summaries((b"<P>",)))
    assert whole.offset(0) == 0 and whole.offset(whole.length) == len(text)
