import hashlib

from pyspark.sql import functions as F

from tapekeeper.llm import exact_dedup
from tapekeeper.llm.queries import op5_exact_dedup
from tapekeeper.llm.shared import ascii_lower

TEXTS = [(1, "Same"), (2, "sAME"), (3, "É"), (4, "é"), (5, ""), (6, None), (7, "long " * 50_000), (8, "LONG " * 50_000),
         (9, "alone"), (9, "ALONE"), (None, "same"), (None, "only here"), (10, "Same ")]


def brute(rows):
    groups = {}
    for i, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        groups.setdefault(low, []).append(i)
    out = []
    for low, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(low.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, digest string, maybe int").repartition(3)


def test_edge_rows(spark):
    found = [tuple(r) for r in exact_dedup.mark_copies(frame(spark, TEXTS)).collect()]
    assert sorted(found, key=str) == brute(TEXTS)


def test_full_filter_changes_nothing(spark):
    found = exact_dedup.mark_copies(frame(spark, TEXTS * 2), bits_per_row=1, probes=1, max_bits=9)
    assert sorted(map(tuple, found.collect()), key=str) == brute(TEXTS * 2)


def test_drop_keeps_columns_and_one_row_per_text(spark):
    docs = frame(spark, TEXTS + TEXTS)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == kept.select(ascii_lower(F.coalesce("text", F.lit("")))).distinct().count() == 8
    assert {r.doc_id for r in kept.collect()} == {2, 3, 4, 6, 8, 9, 10, None}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.mark_copies(docs).count() == 0 and exact_dedup.drop_copies(docs).count() == 0


def test_filter_passes_singles_straight(spark):
    numbers = spark.range(40_000).select(F.xxhash64("id").alias("h"))
    twice = spark.range(100).select(F.xxhash64("id").alias("h"))
    test = exact_dedup.repeat_test(numbers.union(twice), "h")
    flagged = numbers.select(F.col("h"), test("h").alias("maybe"))
    assert twice.join(flagged.filter("not maybe"), "h").count() == 0
    assert flagged.filter("maybe").count() < 600


def test_query(spark, sf):
    rows = [tuple(r) for r in op5_exact_dedup(spark, sf).collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(rows, key=str) == brute(docs)


def test_parts_of_the_hash_space_have_filters_of_their_own(spark):
    """Three filters instead of one: the same result, and hardly more rows are taken for copies."""
    rows = spark.range(100_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 99_000).cast("string")).alias("text"))
    hashed = rows.withColumn("h", F.xxhash64("text")).repartition(4)
    few = 1 << 19
    parted = exact_dedup.flagged(hashed, "h", max_bits=few)
    copies = F.when((F.col("doc_id") < 1000) | (F.col("doc_id") >= 99_000), 1)
    total, caught, maybe = parted.agg(F.count("maybe"), F.count(F.when(F.col("maybe"), copies)), F.count_if("maybe")).first()
    assert (total, caught) == (100_000, 2000) and maybe < 2000 + 4000
    crowded = hashed.withColumn("m", exact_dedup.repeat_test(hashed.select("h"), "h", max_bits=few // 8)("h")).filter("m").count()
    assert crowded > 2 * maybe
    assert exact_dedup.drop_copies(rows, max_bits=few).count() == 99_000
    assert exact_dedup.mark_copies(rows, max_bits=few).filter("kept").count() == 99_000


def test_copies_without_an_id_or_with_one_id_spread_over_salts(spark):
    from tapekeeper.llm.shared import SALTS, with_groups
    for value in (None, 5):
        rows = spark.range(5000).select(F.lit(value).cast("long").alias("id"), F.lit("d").alias("digest"))
        assert {(r.chosen, r.group_size) for r in with_groups(rows, "digest", F.max).distinct().collect()} == {(value, 5000)}
        plan = with_groups(rows, "digest", F.max)._jdf.queryExecution().optimizedPlan().toString()
        assert "salt" in plan and SALTS > 1
