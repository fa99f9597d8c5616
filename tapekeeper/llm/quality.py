"""Quality scores: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates."""

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tapekeeper.llm.shared import WordHashes, plain, sigmoid, text_of
from tapekeeper.llm.training import Example

PLACES = 1 << 20
TOKEN = re.compile(r"\w+|[^\w\s]+")

# Odd multipliers that mix two word hashes, and the hash of "the same word again".
LEFT, RIGHT, AGAIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class Linear(NamedTuple):
    weights: np.ndarray   # one per place, most of them 0
    bias: float


def ngrams():
    """A function from a text to its hashed words and word pairs: (places, log counts scaled to length 1).

    Words keep their case; runs of signs are words too. A word right after itself, or with one other
    between, makes one shared pair, so repetition counts whatever is repeated.
    """
    hashes = WordHashes()

    def of(text: str) -> tuple[np.ndarray, np.ndarray]:
        codes = np.array(list(map(hashes.__getitem__, TOKEN.findall(text))), np.uint64)
        pairs = np.where(codes[1:] == codes[:-1], AGAIN, (codes[:-1] * LEFT) ^ (codes[1:] * RIGHT))
        skipped = np.full(np.count_nonzero((codes[2:] == codes[:-2]) & (codes[1:-1] != codes[2:])), AGAIN)
        mixed = np.concatenate([codes * RIGHT, pairs * LEFT, skipped * RIGHT]) >> np.uint64(44)
        places, counts = np.unique(mixed, return_counts=True)
        values = np.log1p(counts)
        return places, values / max(np.sqrt((values * values).sum()), 1e-12)

    return of


def fit_ftrl(rows: list[Example], alpha: float = 1.0, beta: float = 1.0, l1: float = 0.05, l2: float = 0.1,
             passes: int = 5, seed: int = 1) -> Linear:
    """Follow-the-proximal-leader, a row at a time with per-place rates; labels 0 and 1.

    Without rows the score is a half; with one label only, the bias learns it.
    """
    z, n, w = np.zeros(PLACES + 1), np.zeros(PLACES + 1), np.zeros(PLACES + 1)
    order = np.random.default_rng(seed)
    for _ in range(passes):
        for i in order.permutation(len(rows)).tolist():
            label, places, values = rows[i]
            at, x = np.append(places.astype(np.int64), PLACES), np.append(values.astype(np.float64), 1.0)
            slack = np.where(at < PLACES, l1, 0.0)
            now = np.where(np.abs(z[at]) <= slack, 0.0, -(z[at] - np.sign(z[at]) * slack) / ((beta + np.sqrt(n[at])) / alpha + l2))
            gradient = (sigmoid(now @ x) - label) * x
            z[at] += gradient - (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / alpha * now
            n[at] += gradient**2
    slack = np.full(PLACES + 1, l1)
    slack[-1] = 0.0
    w = np.where(np.abs(z) <= slack, 0.0, -(z - np.sign(z) * slack) / ((beta + np.sqrt(n)) / alpha + l2))
    return Linear(w[:-1].astype(np.float32), float(w[-1]))


def score_quality(docs: DataFrame, model: Linear, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score) per row: the sigmoid of a sparse dot product over the whole text; empty and null texts get the bias alone.

    The weights are one broadcast table of fixed size (4 MB).
    """
    weights, bias = docs.sparkSession.sparkContext.broadcast(model.weights), model.bias

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, table = ngrams(), weights.value
        for batch in batches:
            products = []
            for text in batch.column(1):
                places, values = of(text.as_py())
                products.append(float(table[places.astype(np.int64)] @ values) + bias)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sigmoid(np.array(products, np.float64)))], names=["id", "score"])

    rows = docs.select(plain(id_column).alias("id"), text_of(text_column).alias("text"))
    return rows.mapInArrow(score, f"id {rows.schema['id'].dataType.simpleString()}, score double")
