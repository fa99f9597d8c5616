import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tapekeeper.llm import packing
from tapekeeper.llm.queries import op2_packing, special_tokens
from tapekeeper.llm.shared import written

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def tokens(docs, **names):
    special = special_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return written(packing.tokenize(docs, RANKS, public_tokenizers.PATTERN, 1, special, **names), "tokens")


def test_special_strings_are_the_librarys_ids(spark, coder):
    mark = "<|endoftext|>"
    texts = [mark, f"{mark}a", f"a{mark}", f"hello {mark} world", mark * 3, f" {mark}\n{mark} ", mark[:-1], f"<{mark}>", f"{mark.upper()} é{mark}é", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc: np.frombuffer(r.ids, "<u4").tolist() for r in tokens(docs).collect()}
    for number, text in enumerate(texts):
        assert found[number] == coder.encode(text, add_special_tokens=False).ids + [1], text
    assert 50256 in found[3]
    plain = packing.tokenize(docs, RANKS, public_tokenizers.PATTERN, 1).collect()
    assert not any(50256 in np.frombuffer(r.ids, "<u4") for r in plain)


def test_query_against_the_tokenizers_library(spark, sf, coder):
    rows = op2_packing(spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").toPandas()
    ids = {d: np.array(coder.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
           for d, t in zip(docs.doc_id, docs.text)}
    rows = rows.sort_values(["sequence_id", "offset"])
    total = sum(map(len, ids.values()))
    assert rows.length.sum() == total
    assert (rows.groupby("sequence_id").length.sum().iloc[:-1] == 2048).all()
    assert rows.sequence_id.max() == (total - 1) // 2048
    for _, of in rows.groupby("sequence_id"):
        assert (of.offset == of.length.cumsum() - of.length).all()
    for r in rows.itertuples():
        whole = ids[r.doc_id]
        assert r.doc_tokens == len(whole)
        assert zlib.crc32(whole[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert r.cut_before == (r.start > 0) and r.cut_after == (r.start + r.length < len(whole))
    for d, of in rows.sort_values("start").groupby("doc_id"):
        assert (of.start == of.length.cumsum() - of.length).all() and of.length.sum() == len(ids[d])


def test_edge_rows_and_whole_windows(spark, coder):
    texts = [None, "", "a " * 9000, "<|endoftext|> x", "same", "same", "é\u0000漢字\U0001f600"]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "no id", None, None)]
    docs = spark.createDataFrame(rows, "`doc.id` long, body string, ids string, tokens string").repartition(3)
    table = tokens(docs, id_column="doc.id", text_column="body")
    pieces = packing.pack(table, 64)
    assert pieces.filter("doc is null").count() == 1
    whole = {r.sequence_id: r for r in packing.sequences(pieces, 64, pad_id=7).collect()}
    total = sum(len(coder.encode(t or "", add_special_tokens=False).ids) + 1 for t in [*texts, "no id"])
    assert len(whole) == -(-total // 64) and sum(r.filled for r in whole.values()) == total
    last = whole[len(whole) - 1]
    assert len(last.ids) == (last.filled * 4 if last.filled.bit_count() == 1 else 256)
    assert all(len(r.ids) == 256 for k, r in whole.items() if k < len(whole) - 1)


def test_no_documents(spark):
    assert packing.pack(tokens(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_starts_over_many_blocks(spark):
    parts = spark.range(5000).select(F.col("id").alias("part"), (F.col("id") % 7 + 1).alias("tokens"))
    found = {r.part: r["first"] for r in packing.part_starts(parts).collect()}
    run = 0
    for part in range(5000):
        assert found[part] == run
        run += part % 7 + 1
