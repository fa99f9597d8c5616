"""Exact duplicates by two passes over a Bloom filter: only rows whose hash may repeat are shuffled."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tapekeeper.llm.shared import ascii_lower, plain, shared_folder, text_of, with_groups, written

# Fixed value: bits in one of Spark's bitmaps.
BITMAP_BITS = 32768

# Places a hash has in a filter, and bits of one filter at most: 128 MB on the driver and in a task.
PROBES, MAX_BITS = 2, 1 << 30


def _positions(hash_column: Column, bits: int, probes: int) -> Column:
    """The distinct places of a hash in a filter of ``bits`` (a power of two)."""
    high, low = F.shiftrightunsigned(hash_column, 32), hash_column.bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(1))
    return F.array_distinct(F.array(*[(high + low * i).bitwiseAND(F.lit(bits - 1)) for i in range(probes)]))


def repeat_test(hashes: DataFrame, name: str, bits_per_row: int = 16, probes: int = PROBES, max_bits: int = MAX_BITS):
    """Pass one: a column function telling which hashes may occur more than once. It is never wrong about those that do.

    The filter keeps the places that two rows or more have set. Rows are counted into places by
    Spark, so a hash with very many copies is one row per task in the shuffle, and folded into 4 KB
    bitmaps. What reaches the driver and is broadcast is at most ``max_bits`` / 8 bytes.
    """
    spark, rows = hashes.sparkSession, max(1, hashes.count())
    bits = max(BITMAP_BITS, min(max_bits, 1 << (rows * bits_per_row - 1).bit_length()))
    places = hashes.select(F.explode(_positions(plain(name), bits, probes)).alias("place"))
    twice = places.groupBy("place").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    number = F.col("place") + 1  # Spark numbers the first bitmap's bits from 1
    bitmaps = twice.groupBy(F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))
    field = np.zeros(bits // 8, np.uint8)
    for row in bitmaps.collect():
        at, part = (row["bucket"] - 1) * BITMAP_BITS // 8, np.frombuffer(bytes(row["bitmap"]), np.uint8)
        field[at:at + len(part)] = part
    shared = spark.sparkContext.broadcast(field)

    @F.pandas_udf("boolean")
    def may_repeat(values: pd.Series) -> pd.Series:
        filled, mask = shared.value, np.uint64(bits - 1)
        h = values.to_numpy(np.int64).astype(np.uint64)
        high, low = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
        found = np.ones(len(h), bool)
        for i in range(probes):
            place = (high + low * np.uint64(i)) & mask
            found &= (filled[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return pd.Series(found)

    return may_repeat


def flagged(rows: DataFrame, name: str, bits_per_row: int = 16, probes: int = PROBES, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows with ``maybe``: whether their hash may occur more than once.

    More rows than one filter has room for are written by parts of the hash space, and each part is tested against a filter of its
    own, one after the other: at any size as few rows are taken for copies, and one filter is held at a time.
    """
    parts = -(-rows.count() * bits_per_row // max_bits)
    if parts <= 1:
        return rows.withColumn("maybe", repeat_test(rows.select(name), name, bits_per_row, probes, max_bits)(name))
    folder = shared_folder(rows.sparkSession, "by-hash")
    dealt = rows.withColumn("part_", F.pmod(F.xxhash64(name), F.lit(parts)).cast("int"))
    dealt.write.option("compression", "zstd").partitionBy("part_").parquet(folder)
    stored, done = rows.sparkSession.read.schema(dealt.schema).parquet(folder), None
    for part in range(parts):
        mine = stored.filter(F.col("part_") == part).drop("part_")
        tested = written(mine.withColumn("maybe", repeat_test(mine.select(name), name, bits_per_row, probes, max_bits)(name)), "flagged")
        done = tested if done is None else done.unionByName(tested)
    return done


def mark_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **filter_options) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) for every row; texts are equal but for the case of A-Z.

    The row with the largest id stays. Null text equals empty text. A null id counts as smallest:
    it stays only in a group without any other. Rows that share the largest id of a group are one document and are
    all marked as kept. ``digest`` is the SHA-256 of the lower-cased text in hex. The text is read
    once; ids and hashes are written, and of these only rows that may repeat shuffle.
    """
    text = ascii_lower(text_of(text_column))
    rows = written(docs.select(plain(id_column).alias("id"), F.sha2(text, 256).alias("digest"),
                               F.xxhash64(text).alias("h")), "digests")
    tested = written(flagged(rows, "h", **filter_options).select("id", "digest", "maybe"), "tested")
    maybe = tested.filter("maybe").drop("maybe")
    single = tested.filter("not maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    several = with_groups(maybe, "digest", F.max).select(
        "id", F.col("chosen").alias("keep_id"), "group_size", F.col("id").eqNullSafe(F.col("chosen")).alias("kept"), "digest")
    return single.unionByName(several)


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **filter_options) -> DataFrame:
    """The rows of ``docs`` that ``mark_copies`` keeps, all columns; of rows that tie for a group's largest id, one.

    Rows whose hash cannot repeat go from the scan to the result without a shuffle; the others are written once.
    """
    text = ascii_lower(text_of(text_column))
    rows = docs.select(F.struct(*[plain(c) for c in docs.columns]).alias("row"), plain(id_column).alias("id"),
                       text.alias("low")).withColumn("h", F.xxhash64("low"))
    tested = flagged(rows, "h", **filter_options)
    single = tested.filter("not maybe").select("row.*")
    maybe = written(tested.filter("maybe").select("row", "id", F.sha2("low", 256).alias("digest")), "maybe")
    survivors = with_groups(maybe, "digest", F.max).filter(F.col("id").eqNullSafe(F.col("chosen")))
    return single.unionByName(survivors.dropDuplicates(["digest"]).select("row.*"))
