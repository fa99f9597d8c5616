"""Ranked lexical search without an index: an automaton of all item terms counts their occurrences in each text."""

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tapekeeper.llm.shared import ascii_lower, plain, text_of, written

# Fixed value: a term is a run of ASCII letters, digits and characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Bytes of the terms of a block of items, and items in it, at most: what one automaton and its posting lists are made of.
BLOCK_BYTES, BLOCK_ITEMS = 1 << 22, 8192

# Scores computed at a time: documents by items.
CELLS = 1 << 21

# Tasks that the best documents of an item meet in first.
SPREAD = 64

# The scale of term weights, and of the saturated term frequency with its constants.
WEIGHT, GAIN, STEP, SLOPE = 1000, 1_000_000_000, 1000, 20

# ASCII letters in lower case, every byte that no term holds a space; bytes beyond ASCII belong to terms.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Block(NamedTuple):
    """Some of the items: their ids, their distinct terms, and for each term the items that hold it."""

    items: pa.Array
    terms: list[str]      # normalised bytes, one character a byte
    starts: np.ndarray    # per term: where its items begin in ``holders``; one more at the end
    holders: np.ndarray
    longest: int          # most terms of an item


def item_blocks(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> list[Block]:
    """All items in blocks of bounded size. Rows that share an id are one item with the terms of all their texts; so are
    those without an id. A single item may exceed a block's size, and then is a block of its own."""
    found = F.regexp_extract_all(ascii_lower(text_of(text_column)), F.lit(f"({TERM})"), F.lit(1))
    terms = items.select(plain(id_column).cast("bigint").alias("item"), F.explode(found).alias("term"))
    listed = written(terms.groupBy("item").agg(F.array_sort(F.collect_set("term")).alias("terms")), "items")
    size = F.aggregate("terms", F.lit(0).cast("bigint"), lambda s, t: s + F.octet_length(t) + 1)
    total, count = listed.agg(F.sum(size), F.count(F.lit(1))).first()
    if not count:
        return []
    blocks = max(math.ceil(total / BLOCK_BYTES), math.ceil(count / BLOCK_ITEMS))
    while True:
        number = F.pmod(F.xxhash64(F.coalesce("item", F.lit(-1))), F.lit(blocks))
        full = listed.groupBy(number.alias("block")).agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("items")).filter(
            f"(bytes > {BLOCK_BYTES} or items > {BLOCK_ITEMS}) and items > 1")
        if blocks >= 64 * count or full.isEmpty():
            break
        blocks *= 2
    return [block for n in range(blocks) if (block := _block(listed.filter(number == n).orderBy("item").toArrow()))]


def _block(rows: pa.Table) -> Block | None:
    if not len(rows):
        return None
    held: dict[str, list[int]] = {}
    lists = rows.column("terms").to_pylist()
    for item, terms in enumerate(lists):
        for term in terms:
            held.setdefault(term.encode().decode("latin-1"), []).append(item)
    terms = sorted(held)
    sizes = [len(held[t]) for t in terms]
    return Block(rows.column("item").combine_chunks(), terms, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
                 np.array([i for t in terms for i in held[t]], np.int64), max(map(len, lists)))


def automaton(terms: list[str]):
    """Finds the terms, each between two spaces, which texts have at the borders of words; it yields their numbers."""
    import ahocorasick

    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for number, term in enumerate(terms):
        found.add_word(f" {term} ", number)
    found.make_automaton()
    return found


def scan(docs: DataFrame, block: Block, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n, terms, counts) of rows with at least one term of their own: how many they have, and the block's terms among
    them with their occurrences. Whole texts go past the automaton, which travels to the tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton(block.terms))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, number = shared.value, itemgetter(1)
        for batch in batches:
            kept, sizes, ends, terms, counts = [], [], [0], [], []
            for row, text in enumerate(batch.column(1)):
                normal = text.as_py().translate(NORMAL)
                if n := len(normal.split()):
                    hits = Counter(map(number, found.iter(f" {normal.decode('latin-1')} ")))
                    kept.append(row)
                    sizes.append(n)
                    terms.extend(hits.keys())
                    counts.extend(hits.values())
                    ends.append(len(terms))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept, pa.int32())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(counts, pa.int64()))],
                names=["id", "n", "terms", "counts"])

    rows = docs.select(plain(id_column).cast("bigint").alias("id"), text_of(text_column).cast("binary").alias("text"))
    return rows.mapInArrow(count, "id bigint, n bigint, terms array<int>, counts array<bigint>")


class Best:
    """The ``k`` best documents of each item so far: higher scores first, then smaller ids, those without an id last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)  # the score from which a document may matter
        blank = np.empty(0, np.int64)
        self.rows = [(blank, blank, np.empty(0, bool), blank)]
        self.pending = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        self.rows.append((item, scores[row, item], unnamed[row], ids[row]))
        self.pending += len(row)
        if self.pending > 4 * self.k * len(self.least) + CELLS:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        item, score, unnamed, ids = (np.concatenate(x) for x in zip(*self.rows))
        order = np.lexsort((ids, unnamed, -score, item))
        item = item[order]
        start = np.searchsorted(item, np.arange(len(self.least) + 1))
        place = np.arange(len(item)) - start[item]
        kept = order[place < self.k]
        full = np.nonzero(np.diff(start) >= self.k)[0]
        self.least[full] = score[order[start[full] + self.k - 1]]
        self.rows, self.pending = [(item[place < self.k], score[kept], unnamed[kept], ids[kept])], 0
        return self.rows[0]


def lengths(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a document's length does to its scores: 50 and half a hundred times its length over the mean, rounded down."""
    if 50 * int(n.max(initial=0)) * documents < 1 << 63:
        return 50 + 50 * n * documents // total
    return np.array([50 + 50 * int(x) * documents // total for x in n], np.int64)


def _summed(place: np.ndarray, values: np.ndarray, size: int, exact: bool) -> np.ndarray:
    """Sums of whole numbers by place; through doubles where these hold them exactly."""
    if exact:
        return np.bincount(place, values, size).astype(np.int64)
    sums = np.zeros(size, np.int64)
    np.add.at(sums, place, values)
    return sums


def best_documents(counted: DataFrame, block: Block, weights: np.ndarray, documents: int, total: int, k: int) -> DataFrame:
    """(item, id, score): from each task the best ``k`` documents it has of each item of the block."""
    spark = counted.sparkSession
    shared = spark.sparkContext.broadcast((block.starts, block.holders, weights))
    items, exact = len(block.items), int(weights.max(initial=0)) * (GAIN // STEP) * block.longest < 1 << 53

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, holders, weights = shared.value
        best, step = Best(items, k), max(1, CELLS // items)
        fan = np.diff(starts)
        for batch in batches:
            unnamed = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            m = lengths(batch.column(1).to_numpy(zero_copy_only=False), documents, total)
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            ends = np.concatenate([[0], np.cumsum(sizes)])
            terms = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            tf = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            gains = weights[terms] * (GAIN * tf // (STEP * tf + SLOPE * m[doc]))
            reach = np.concatenate([[0], np.cumsum(fan[terms])])  # (document, item) contributions before each (document, term)
            first = 0
            while first < len(sizes):
                # As many documents as fit by scores and by contributions, one at least.
                last = min(len(sizes), first + step)
                last = max(first + 1, min(last, int(np.searchsorted(reach[ends], reach[ends[first]] + 4 * CELLS, "right")) - 1))
                part = slice(ends[first], ends[last])
                copies = fan[terms[part]]
                at = np.repeat(starts[terms[part]] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())
                place = np.repeat(doc[part] - first, copies) * items + holders[at]
                sums = _summed(place, np.repeat(gains[part], copies), (last - first) * items, exact)
                best.add(sums.reshape(-1, items), ids[first:last], unnamed[first:last])
                first = last
        item, scores, unnamed, ids = best.cut()
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=unnamed), pa.array(scores)], names=["item", "id", "score"])

    return counted.mapInArrow(score, "item bigint, id bigint, score bigint")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, id_column: str = "doc_id", text_column: str = "text",
                   item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` highest-scoring documents, equal scores by ascending id.

    Whole texts; terms are compared with A-Z lower-cased; null text has none. Ids are whole numbers. Every row is a document, whatever
    others have its id; documents without an id come after others of the same score. Items that share an id, or have none, are
    one. Only scores above 0 count; an item none of whose terms occurs has no rows.

    Items come in blocks of bounded size. For each block all texts pass an automaton of its terms once, which leaves each text's term counts; document
    counts and lengths come from these, and a second pass scores documents against the
    block's items in dense pieces and returns each task's best, so no pair of document and item is ever shuffled that
    is not among the best of its task.
    """
    spark, shape = docs.sparkSession, "item_id bigint, rank int, doc_id bigint, score bigint"
    found, documents, total = None, 0, 0
    for block in item_blocks(items, item_column, item_text_column):
        counted = written(scan(docs, block, id_column, text_column), "counted")
        documents, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            break
        holding = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        df = np.zeros(len(block.terms), np.int64)
        for term, n in holding.collect():  # as many as the block has terms, at most
            df[term] = n
        weights = np.array([math.floor(WEIGHT * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)
        some = best_documents(counted, block, weights, documents, total, k)
        names = spark.createDataFrame(list(enumerate(block.items.to_pylist())), "item bigint, item_id bigint")
        some = some.join(F.broadcast(names), "item").select("item_id", "id", "score")  # a block's items: at most BLOCK_ITEMS
        found = some if found is None else found.unionByName(some)
    if found is None:
        return spark.createDataFrame([], shape)
    found = found.withColumn("salt", F.pmod(F.xxhash64("id", "score"), F.lit(SPREAD)))
    order = [F.desc("score"), F.asc_nulls_last("id")]
    near = found.withColumn("nth", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).filter(F.col("nth") <= k)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", F.col("id").alias("doc_id"), "score")
