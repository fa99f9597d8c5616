"""SimHash near-duplicates by covering locality-sensitive hashing."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tapekeeper.llm.components import components
from tapekeeper.llm.shared import plain, text_of, written

# Fixed value: the seed of the shingle hash.
SEED = 42

# Distinct fingerprints that one task compares with as many others.
SIDE = 2048

# Shingle hashes turned into bits at a time.
STEP = 1 << 14


def text_fingerprint(text: str, words: int) -> int:
    """The 64-bit SimHash of one text.

    A-Z are lower-cased, words are runs of anything but ASCII white space, and shingles of ``words``
    words count as often as they occur; with fewer words the whole sequence is the one shingle. A
    bit is 1 if set in over half of the XXH64 hashes. No word: 0.
    """
    from xxhash import xxh64_intdigest

    parts = text.encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    reach = min(words, len(parts))
    total, counts = len(parts) - reach + 1, np.zeros(64, np.int64)
    for first in range(0, total, STEP):
        last = min(total, first + STEP)
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(
            starts[first:last].tolist(), ends[first + reach - 1:last + reach - 1].tolist())], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int, id_column: str = "doc_id", text_column: str = "text",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, fingerprint) per row, the fingerprint as a signed 64-bit number; null text is empty text.

    ``keep`` names columns of ``docs`` to hand through, in a struct ``row``.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [text_fingerprint(text.as_py(), words) for text in batch.column(1)]
            signed = np.array(values, np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], names=["key", "fingerprint"])

    carried = [plain(id_column).alias("id"), *([F.struct(*[plain(c) for c in keep]).alias("row")] if keep else [])]
    rows = docs.select(F.struct(*carried).alias("key"), text_of(text_column).alias("text"))
    marked = rows.mapInArrow(hashed, f"key {rows.schema['key'].dataType.simpleString()}, fingerprint bigint")
    return marked.select("key.id", "fingerprint", *(["key.row"] if keep else []))


def covering_masks(radius: int, seed: int = 7) -> list[int]:
    """2^(radius+1) - 1 masks of 64 bits: of any two numbers within ``radius`` bits, some mask hides all their differences.

    Each bit gets a random vector of radius + 1 bits; the mask of a non-zero vector v holds the bits
    whose vector has an odd product with v. Up to ``radius`` vectors leave some v orthogonal to them all.
    """
    vectors = np.random.default_rng(seed).integers(0, 1 << (radius + 1), 64).tolist()
    return [sum(1 << i for i, vector in enumerate(vectors) if (vector & v).bit_count() & 1)
            for v in range(1, 1 << (radius + 1))]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _near(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of numbers within ``radius`` bits, compared in blocks of rows."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for first in range(0, len(left), 256):
        i, j = np.nonzero(np.bitwise_count(left[first:first + 256, None] ^ right[None, :]) <= radius)
        found.append((i + first, j))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _forest(i: np.ndarray, j: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Of links between numbered nodes, as few as keep the same nodes connected."""
    parent, kept = list(range(size)), []

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in zip(i.tolist(), j.tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            kept.append((a, b))
    return kept


def fingerprint_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect just what the pairs of fingerprints at most ``radius`` bits apart connect.

    Every fingerprint goes into a bucket of each covering mask. A bucket of two is one comparison;
    a larger one is cut into sides of about 2048 fingerprints, and tasks compare side with side and
    return a spanning forest of what they linked, never all pairs. No bucket is capped: a large one only makes
    more tasks, each bounded.
    """
    masks = F.array(*[F.lit(_signed(mask)) for mask in covering_masks(radius)])
    keys = distinct.select("fingerprint", F.posexplode(masks).alias("table", "mask")).select(
        "fingerprint", "table", F.col("mask").bitwiseAND(F.col("fingerprint")).alias("key"))
    buckets = written(keys.groupBy("table", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b")).filter("n > 1"), "buckets")
    pairs = buckets.filter("n = 2").select("a", "b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)

    large = buckets.filter("n > 2").select("table", "key", F.expr(f"(n + {SIDE - 1}) div {SIDE}").alias("sides"))
    sided = keys.join(large, ["table", "key"]).withColumn("side", F.pmod(F.xxhash64("fingerprint"), F.col("sides")))
    # A side meets itself and every other side once: (low, high) names the meeting.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1))
    meetings = sided.withColumn("other", other).select(
        "table", "key", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"),
        "fingerprint", (F.col("side") <= F.col("other")).alias("left"))
    place = ["table", "key", "low", "high"]

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        values = rows["fingerprint"].to_numpy(np.int64).astype(np.uint64)
        if rows["low"].iat[0] == rows["high"].iat[0]:
            values = np.unique(values)
            i, j = _near(values, values, radius)
            i, j = i[i < j], j[i < j]
        else:
            left = rows["left"].to_numpy(bool)
            a, b = np.unique(values[left]), np.unique(values[~left])
            i, j = _near(a, b, radius)
            values, j = np.concatenate([a, b]), j + len(a)
        links = np.array(_forest(i, j, len(values)), np.int64).reshape(-1, 2)
        ends = values.astype(np.int64)
        return pd.DataFrame({"a": ends[links[:, 0]], "b": ends[links[:, 1]]})

    # Few bytes, much work: a number of partitions by the work, which Spark does not join into few by their size.
    work = buckets.filter("n > 2").agg(F.sum(F.expr(f"n * ((n + {SIDE - 1}) div {SIDE})"))).first()[0] or 0
    tasks = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-work // (2 * SIDE)))
    compared = meetings.repartition(int(tasks), *place).groupBy(*place).applyInPandas(compare, "a bigint, b bigint")
    return pairs.unionByName(compared)


def _with_components(classes: DataFrame, radius: int) -> DataFrame:
    """Rows of ``classes``, one per fingerprint, with the ``component`` of linked fingerprints they are in."""
    joined = written(fingerprint_links(classes.select("fingerprint"), radius), "near")
    member = components(joined).withColumnRenamed("node", "fingerprint")
    return classes.join(member, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))


def group_near_copies(docs: DataFrame, words: int, radius: int, id_column: str = "doc_id",
                      text_column: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) per row: fingerprints as numbers, component_id the smallest id reachable by links.

    Rows link when their fingerprints differ in at most ``radius`` bits. Rows of one fingerprint are
    one node, so copies are never expanded into pairs. Texts without a word have fingerprint 0 and
    link like any other. Null ids are ignored when the smallest is sought.
    """
    marked = written(fingerprints(docs, words, id_column, text_column), "fingerprints")
    whole = _with_components(written(marked.groupBy("fingerprint").agg(F.min("id").alias("first")), "classes"), radius)
    named = whole.join(whole.groupBy("component").agg(F.min("first").alias("component_id")), "component").select(
        "fingerprint", "component_id")
    return marked.join(written(named, "named"), "fingerprint").select("id", "fingerprint", "component_id")


def drop_near_copies(docs: DataFrame, words: int, radius: int, id_column: str = "doc_id",
                     text_column: str = "text") -> DataFrame:
    """Exactly one row of each group, all columns: the one with the smallest id, a null id only if none has another.

    Of rows that tie for it the one with the smallest fingerprint, then digest of all columns, is kept; rows
    alike in all are interchangeable. Rows are numbered as they are written, and dropped by number:
    ids may be null or repeat, in one group or in several.
    """
    digest = F.md5(F.to_json("row", {"ignoreNullFields": "false"}))
    rows = written(fingerprints(docs, words, id_column, text_column, tuple(docs.columns)).withColumns(
        {"digest": digest, "number": F.monotonically_increasing_id()}), "rows")
    best = F.min(F.struct(F.isnull("id").alias("unnamed"), "id", "digest", "number")).alias("best")
    whole = _with_components(written(rows.groupBy("fingerprint").agg(best), "classes"), radius)
    order = F.struct("best.unnamed", "best.id", "fingerprint", "best.digest", "best.number")
    winners = whole.groupBy("component").agg(F.min(order).alias("best")).select("best.number")
    losers = written(rows.select("number").join(winners, "number", "left_anti"), "losers")
    return rows.join(losers, "number", "left_anti").select("row.*")
