"""The registered queries of this subpackage: each applies one operator to its whole table."""

import functools
import json
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tapekeeper.llm import chat, exact_dedup, infill, inner_search, langid, lexical, licenses, packing, piece_tokens, quality, simhash, toxicity, vector_links
from tapekeeper.llm.shared import plain, sample_rows, ship, split_of, written
from tapekeeper.llm.training import examples, row_mark

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The window length, and the id that ends a document.
WINDOW, END = 2048, 1

# Shingle length and bit distance of the SimHash contract.
SHINGLE, RADIUS = 4, 4

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def query(fn):
    """Register under the function's name; the executors get this package first."""

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def special_tokens(path: str) -> dict[str, int]:
    """The strings that a tokenizer file has as tokens of their own."""
    with open(path, encoding="utf-8") as file:
        return {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of the documents in windows, with the ids' checksum."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")  # the ranks of byte_bpe_50k.json, which also names special strings
    special = special_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = written(packing.tokenize(docs, path, public_tokenizers.PATTERN, END, special), "tokens")
    return packing.pack(tokens, WINDOW).select(
        F.col("doc").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "cut_before", "cut_after")


# Most labelled rows a model is fitted on; for toxicity half of them of each label, so that a rare one has its share. For languages: most
# rows of each, most languages (those with the most rows), and most rows of all languages together.
SAMPLE, SAMPLE_PER_LANGUAGE, LANGUAGES, SAMPLE_OF_LANGUAGES = 8000, 1000, 256, 32000

# Toxic rows with at least this expected severity are rejected: half way to grade 1.
REJECTED_SEVERITY = 0.5


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Severity:
    """Fitted on a sample of the labelled rows of ``docs``: grade 0 is not toxic; toxic rows are 2 if they hold more
    words typical of toxic rows than most of them do, else 1."""
    labels = table(spark, sf_dir, "labels").filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    sample = sample_rows(labels, "doc_id", SAMPLE // 2, "label").select(F.col("doc_id").alias("id"), "label")
    rows = examples(docs, sample, toxicity.word_presence)
    toxic = np.array([r.label > 0 for r in rows], bool)
    places = toxicity.telling_places(rows, toxic)
    hits = np.array([np.isin(r.places, places).sum() for r in rows])
    heavy = hits > np.median(hits[toxic]) if toxic.any() else toxic
    known, positive = labels.agg(F.count(F.lit(1)), F.count_if(F.col("label") > 0)).first()
    return toxicity.fit_severity(rows, places, toxic.astype(int) + (toxic & heavy), share=(positive + 0.5) / (known + 1))


@query
def op1_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    scored = toxicity.score_severity(docs, toxicity_model(spark, docs, sf))
    return scored.select(F.col("id").alias("doc_id"), "severity", "grade", (F.col("severity") >= REJECTED_SEVERITY).alias("rejected"))


@query
def op2_packing(spark, sf):
    return packed(table(spark, sf, "documents"))


def _mask_text(mask: str):
    """A mask as text: the characters of each run, with + if trained and - if not."""
    return F.array_join(F.transform(mask, lambda m: F.concat(
        m["chars"].cast("string"), F.when(m["trained"], F.lit("+")).otherwise(F.lit("-")))), " ")


@query
def op3_preferences(spark, sf):
    """Every conversation as chosen; rejected is its first half, then the rest of its neighbour (2k with 2k + 1)."""
    turns = table(spark, sf, "conversations")
    cuts = turns.groupBy("conv_id").agg(F.expr("count(*) div 2").alias("cut")).select(F.col("conv_id").alias("pair_id"), "cut")
    opening = turns.join(cuts, turns["conv_id"] == cuts["pair_id"]).filter("turn < cut")
    neighbour = turns.join(cuts, F.col("conv_id").bitwiseXOR(F.lit(1)) == cuts["pair_id"]).filter("turn >= cut")
    rejected = opening.unionByName(neighbour).select("pair_id", "turn", "role", "text")
    pairs = chat.format_preferences(turns.withColumnRenamed("conv_id", "pair_id"), rejected)
    return pairs.withColumns({"chosen_mask": _mask_text("chosen_mask"), "rejected_mask": _mask_text("rejected_mask")})


# Of four parts of the documents, the one that is never learned from; and of three, for quality.
LANGUAGE_PARTS, LANGUAGE_HELD, QUALITY_PARTS, QUALITY_HELD = 4, 2, 3, 1


def language_model(docs: DataFrame) -> langid.Languages:
    """Fitted on at most 1,000 texts of each language, none of them of the held-out part."""
    known = docs.filter("lang is not null and doc_id is not null").filter(
        split_of(plain("doc_id"), LANGUAGE_PARTS) != LANGUAGE_HELD).select(
        F.col("doc_id").alias("id"), F.col("lang").alias("label"), row_mark().alias("mark"))
    common = written(known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(LANGUAGES), "languages")
    each = min(SAMPLE_PER_LANGUAGE, SAMPLE_OF_LANGUAGES // max(1, common.count()))
    sample = sample_rows(known.join(F.broadcast(common.select("label")), "label"), "id", each, "label")
    return langid.fit_languages(examples(docs, sample, langid.subwords))


@query
def op4_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    found = langid.predict_languages(docs, language_model(docs))
    held = F.coalesce(split_of(plain("id"), LANGUAGE_PARTS) == LANGUAGE_HELD, F.lit(False))
    return found.select(F.col("id").alias("doc_id"), held.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op5_exact_dedup(spark, sf):
    marked = exact_dedup.mark_copies(table(spark, sf, "documents"))
    return marked.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query
def op6_licenses(spark, sf):
    """Documents as files: every hundred of a source a package of ten folders, each tenth document a folder's LICENSE, and
    one of a hundred the package's COPYING."""
    docs = table(spark, sf, "documents")
    package = F.concat("source", F.lit("/p"), F.expr("doc_id div 100"))
    folder = F.concat(package, F.lit("/"), F.expr("doc_id div 10 % 10"))
    path = (F.when(F.expr("doc_id % 100 = 55"), F.concat(package, F.lit("/COPYING")))
            .when(F.expr("doc_id % 10 = 0"), F.concat(folder, F.lit("/LICENSE")))
            .otherwise(F.concat(folder, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))))
    found = licenses.scan_licenses(docs.select("doc_id", path.alias("path"), "text"), "doc_id")
    return found.withColumn("own_score", F.round("own_score", 6)).withColumnRenamed("id", "doc_id")


@query
def op7_vector_links(spark, sf):
    return vector_links.link_vectors(table(spark, sf, "embeddings"), 0.95).withColumnRenamed("id", "vec_id")


@query
def op8_simhash(spark, sf):
    groups = simhash.group_near_copies(table(spark, sf, "documents"), SHINGLE, RADIUS)
    return groups.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
                         "component_id")


@query
def op9_piece_tokens(spark, sf):
    coded = piece_tokens.encode_pieces(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_quality(spark, sf):
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").filter("quality is not null").filter(
        split_of(plain("doc_id"), QUALITY_PARTS) != QUALITY_HELD).groupBy("doc_id").agg(F.max("quality").alias("label"))
    sample = sample_rows(labels, "doc_id", SAMPLE).select(F.col("doc_id").alias("id"), "label")
    model = quality.fit_ftrl(examples(docs, sample, quality.ngrams))
    held = F.coalesce(split_of(plain("id"), QUALITY_PARTS) == QUALITY_HELD, F.lit(False))
    return quality.score_quality(docs, model).select(
        F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op11_infill(spark, sf):
    made = infill.fill_in_middle(table(spark, sf, "documents"))
    back = infill.restored(F.col("form"), F.col("output"))
    return made.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


# Of the vectors, each with an id divisible by this asks for so many best ones.
ASKING, BEST = 100, 10


@query
def op12_inner_search(spark, sf):
    return inner_search.search(table(spark, sf, "embeddings"), f"id % {ASKING} = 0", BEST)


@query
def op13_lexical_search(spark, sf):
    return lexical.rank_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
