import numpy as np
import pytest

from tapekeeper.llm import langid
from tapekeeper.llm.queries import language_model, op4_language_id, table
from tapekeeper.llm.training import Example


def slow_places(text):
    """Subwords one by one: bytes of the lower-cased text, everything else in ASCII a space."""
    raw = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in b" " + text.lower().encode() + b"  " * 2)
    out = []
    for n in langid.ORDERS:
        for i in range(len(raw) - 3 if n == 4 else len(raw) - 4):
            part = raw[i:i + n]
            if len(part) < n or 32 in part[1:-1] or part == b"  ":
                continue
            code = n * 0x3D4D51CB & 0xFFFFFFFF
            for b in part:
                code = (code ^ b) * 0x01000193 & 0xFFFFFFFF
            out.append((code * 0x9E3779B1 & 0xFFFFFFFF) >> 16)
    return out


@pytest.mark.parametrize("text", ["", "a", "The cat.", "É1 straße!! x", "  ", "über" * 50])
def test_subwords_one_by_one(text):
    places, shares = langid.subwords()(text)
    slow = slow_places(text)
    want = np.bincount(slow, minlength=langid.PLACES)
    assert places.tolist() == np.nonzero(want)[0].tolist()
    assert np.allclose(shares, want[places] / max(1, want.sum()))


def toy_model():
    of = langid.subwords()
    words = {"aa": "alpha anna aba ara".split(), "bb": "bolo dodo gogo mono".split()}
    rng = np.random.default_rng(3)
    rows = [Example(k, *of(" ".join(rng.choice(v, 12)))) for k, v in words.items() for _ in range(60)]
    return langid.fit_languages([rows[i] for i in rng.permutation(len(rows))])


def test_batches_slices_and_windows_agree(monkeypatch):
    model = toy_model()
    texts = ["alpha", "", "dodo gogo", "anna " * 300, "!!", "mono", "ß", "ara bolo"]
    whole = langid._scores(texts, model, model.table)
    each = np.concatenate([langid._scores([t], model, model.table) for t in texts])
    monkeypatch.setattr(langid, "STEP", 7)
    cut = langid._scores(texts, model, model.table)
    assert np.allclose(whole, each, atol=1e-5) and np.allclose(whole, cut, atol=1e-5)


def test_edge_rows(spark):
    model = toy_model()
    rows = [(1, "alpha aba"), (2, None), (3, ""), (4, "12 !! ²"), (4, "gogo gogo"), (None, "dodo " * 50_000)]
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "doc_id long, text string, key string, score double")
    found = {(r.id, r.lang_pred, r.rejected) for r in langid.predict_languages(docs, model, keep=("key",)).collect()}
    assert found == {(1, "aa", False), (2, "und", True), (3, "und", True), (4, "und", True), (4, "bb", False), (None, "bb", False)}
    assert langid.predict_languages(docs.limit(0), model).count() == 0
    nothing = langid.fit_languages([])
    assert {r.lang_pred for r in langid.predict_languages(docs, nothing).collect()} == {"und"}


def test_held_out_accuracy_and_und(spark):
    sf = "/root/testdata/sf0.01"
    rows = op4_language_id(spark, sf).collect()
    truth = {r.doc_id: r.lang for r in table(spark, sf, "documents").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and 0.15 < len(held) / len(rows) < 0.35
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.rejected for r in held]) < 0.03


def test_model_never_sees_held_out_rows(spark):
    import zlib
    from pyspark.sql import functions as F

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    lying = docs.withColumn("lang", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2,
                                           F.lit("xx")).otherwise(F.col("lang")))
    assert any(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in lying.filter("lang = 'xx'").collect())
    assert language_model(lying).names == language_model(docs).names


def test_examples_are_of_the_labelled_row(spark):
    """Rows that share an id: each label comes with its own text, and texts without a label teach nothing."""
    from pyspark.sql import functions as F

    from tapekeeper.llm.training import examples, row_mark
    rows = spark.createDataFrame([(7, "aaa", "en"), (7, "bbb", "de"), (7, "ccc", None), (8, "ddd", "de"), (8, "ddd", "de")],
                                 "doc_id long, text string, lang string")
    known = rows.filter("lang is not null").select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), row_mark().alias("mark"))
    def texts():
        return lambda text: (np.array([ord(text[0])]) if text else np.array([0]), np.ones(1))
    found = sorted((r.label, chr(int(r.places[0]))) for r in examples(rows, known, texts))
    assert found == [("de", "b"), ("de", "d"), ("en", "a")]
    by_id = known.drop("mark").filter("label = 'en'")
    assert len(examples(rows, by_id, texts)) == 1 == len(examples(rows.repartition(4), by_id, texts))
