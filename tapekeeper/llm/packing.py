"""Concatenate and cut: documents as one long run of token ids, cut into windows of fixed length."""

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tapekeeper.llm.shared import plain, text_of, written

# Partitions whose totals are summed as one block.
BLOCK = 1024


def _encoding(ranks_path: str, pattern: str, special: dict[str, int]):
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def tokenize(docs: DataFrame, ranks_path: str, pattern: str, end_id: int, special: dict[str, int] | None = None,
             id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc, ids, tokens, part, before) per row: byte-level BPE ids of the whole text, then ``end_id``.

    ``ids`` are little-endian unsigned 32-bit numbers in one binary value. ``before`` counts the ids
    of earlier rows of the same partition ``part``. The rank file is opened inside tasks; the ids
    are those of the same vocabulary in any other library. Null text is empty text. ``special`` names strings that are
    cut out of the text first, each one id; without it they are ordinary text.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, before = _encoding(ranks_path, pattern, special or {}), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids = [coder.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u4").tobytes() + end
                   for text in batch.column(1).to_pylist()]
            counts = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(counts),
                 pa.array(np.full(len(ids), part, np.int64)), pa.array(starts)],
                names=["doc", "ids", "tokens", "part", "before"])

    rows = docs.select(plain(id_column).alias("doc"), text_of(text_column).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc {kind}, ids binary, tokens bigint, part bigint, before bigint")


def part_starts(tokens: DataFrame) -> DataFrame:
    """(part, first): the ids in all earlier partitions. Sums run inside blocks of partitions, then over the blocks."""
    totals = tokens.groupBy("part").agg(F.sum("tokens").alias("n")).withColumn("block", F.expr(f"part div {BLOCK}"))
    inside = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("n").alias("n")).select(
        "block", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("base"))
    rows = totals.withColumn("local", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(blocks, "block")
    return rows.select("part", (F.col("base") + F.col("local")).alias("first"))


def pack(tokens: DataFrame, length: int = 2048) -> DataFrame:
    """Pieces of documents in windows of ``length`` ids; all windows but the very last are full.

    ``tokens`` is a written table as ``tokenize`` makes it. Pass one adds up the ids of each
    partition; pass two turns them into global offsets and cuts. Returns a row per piece: doc, start
    (its document's ids before it), length, ids, doc_tokens, sequence_id, offset (its place in the
    window), cut_before and cut_after (whether the document goes on beyond the window's border). No
    rows for no documents. The table of partition starts has one row per partition; Spark
    broadcasts it only if it finds it small.
    """
    starts = written(part_starts(tokens), "starts")
    placed = tokens.join(starts, "part").withColumn("at", F.col("first") + F.col("before"))
    windows = F.sequence(F.expr(f"at div {length}"), F.expr(f"(at + tokens - 1) div {length}"))
    cut = placed.withColumn("sequence_id", F.explode(windows))
    begin = F.greatest(F.col("at"), F.col("sequence_id") * length)
    end = F.least(F.col("at") + F.col("tokens"), (F.col("sequence_id") + 1) * length)
    pieces = cut.withColumns({"begin": begin, "end": end})
    start, size = F.col("begin") - F.col("at"), F.col("end") - F.col("begin")
    return pieces.select(
        "doc", start.alias("start"), size.alias("length"),
        F.substring("ids", (start * 4 + 1).cast("int"), (size * 4).cast("int")).alias("ids"),
        F.col("tokens").alias("doc_tokens"), "sequence_id",
        (F.col("begin") - F.col("sequence_id") * length).alias("offset"),
        (start > 0).alias("cut_before"), (start + size < F.col("tokens")).alias("cut_after"))


def sequences(pieces: DataFrame, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, filled): whole windows put together; the last is padded unless its length is a power of two."""
    whole = pieces.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("filled"))
    ids = F.aggregate("parts", F.lit(b""), lambda run, part: F.concat(run, part["ids"]))
    short = (F.lit(length) - F.col("filled")).cast("int")
    pad = F.when(F.bit_count("filled") == 1, F.lit(0)).otherwise(short)
    filler = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), pad))
    return whole.select("sequence_id", F.concat(ids, filler).alias("ids"), "filled")
