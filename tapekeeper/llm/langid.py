"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tapekeeper.llm.shared import byte_slices, plain, text_of
from tapekeeper.llm.training import Example

PLACES = 1 << 16

# Bytes of a subword, word borders included.
ORDERS = (2, 3, 4)

# Characters of text, and subword starts, that a task works on at a time.
SLICE, STEP = 1 << 20, 1 << 18

UNKNOWN = "und"

# Every byte as itself, but ASCII other than letters as a space.
_LETTER = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


class Languages(NamedTuple):
    names: list[str]
    table: np.ndarray        # per place, the embedding times the output weights: a logit per language
    bias: np.ndarray
    temperature: float       # divides the logits, so that the probabilities are calibrated
    least: float             # a lower probability is rejected


def _bytes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased texts as letters and spaces in one run, a space around each, and where each starts."""
    parts = [text.lower().encode("utf-8", "replace") for text in texts]
    sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    run = _LETTER[np.frombuffer(b" " + b" ".join(parts) + b" " * max(ORDERS), np.uint8)]
    return run, np.cumsum(sizes) - sizes


def _places(run: np.ndarray, first: int, last: int):
    """For each length of subword, the starts in [first, last) and their places; subwords lie in one word and its borders."""
    part = run[first:last + max(ORDERS)].astype(np.uint32)
    space = part == 32
    for n in ORDERS:
        size = max(0, min(last - first, len(part) - n + 1))
        code, valid = np.full(size, n * 0x3D4D51CB & 0xFFFFFFFF, np.uint32), np.ones(size, bool)
        for k in range(n):
            code = (code ^ part[k:k + size]) * np.uint32(0x01000193)
            if 0 < k < n - 1:
                valid &= ~space[k:k + size]
        if n == 2:
            valid &= ~(space[:size] & space[1:1 + size])
        at = np.nonzero(valid)[0]
        mixed = code[at] * np.uint32(0x9E3779B1)
        yield first + at, (mixed >> np.uint32(16)).astype(np.int64)


def subwords():
    """A function from a text to (places, share of the text's subwords that fall there)."""

    def of(text: str) -> tuple[np.ndarray, np.ndarray]:
        run, _ = _bytes_of([text])
        counts = np.zeros(PLACES, np.int64)
        for first in range(0, len(run), STEP):
            for _, places in _places(run, first, min(len(run), first + STEP)):
                counts += np.bincount(places, minlength=PLACES)
        places = np.nonzero(counts)[0]
        return places, counts[places] / max(1, counts.sum())

    return of


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_languages(rows: list[Example], size: int = 16, passes: int = 8, rate: float = 20.0, rejected: float = 0.002,
                  seed: int = 1) -> Languages:
    """Embeddings and output weights by stochastic gradient descent, a text at a time, on four of five rows.

    On the fifth the temperature that makes the probabilities most likely is found, and ``least`` as
    the probability below which ``rejected`` of its texts fall, at most 0.5. No rows: no language, all is rejected.
    """
    names = sorted({r.label for r in rows})
    number = {name: k for k, name in enumerate(names)}
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1, 1, (PLACES, size)) / size
    out, bias = np.zeros((size, max(1, len(names)))), np.zeros(max(1, len(names)))
    held = [r for i, r in enumerate(rows) if i % 5 == 4]
    taught = [r for i, r in enumerate(rows) if i % 5 != 4]
    total, step = passes * len(taught), 0
    for _ in range(passes):
        for i in random.permutation(len(taught)).tolist():
            label, places, shares = taught[i]
            pace = rate * (1 - step / total)
            step += 1
            if not len(places):
                continue
            hidden = shares @ vectors[places]
            wrong = _softmax(hidden @ out + bias)
            wrong[number[label]] -= 1
            back = out @ wrong
            out -= 0.1 * pace * np.outer(hidden, wrong)
            bias -= 0.001 * pace * wrong
            vectors[places] -= pace * shares[:, None] * back
    table = vectors @ out
    logits = np.array([r.values @ table[r.places] + bias for r in held if len(r.places)]).reshape(-1, len(bias))
    truth = np.array([number[r.label] for r in held if len(r.places)], np.int64)
    each, temperature, least = np.arange(len(truth)), 1.0, 0.0
    if len(truth):
        def loss(t):
            return -np.log(np.maximum(_softmax(logits / t)[each, truth], 1e-12)).mean()

        temperature = float(min(np.geomspace(0.1, 5, 60), key=loss))
        least = float(min(0.5, np.quantile(_softmax(logits / temperature).max(axis=1), rejected)))
    return Languages(names, table.astype(np.float32), bias, temperature, least)


def _scores(texts: list[str], model: Languages, table: np.ndarray) -> np.ndarray:
    """Probabilities per text and language; texts without subwords get the bias alone."""
    run, starts = _bytes_of(texts)
    sums, counts = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts))
    for first in range(0, len(run), STEP):
        last = min(len(run), first + STEP)
        for at, places in _places(run, first, last):
            edges = np.searchsorted(at, starts)
            edges = np.append(edges, len(at))
            held = np.nonzero(edges[1:] > edges[:-1])[0]
            # What stands before the first start in this step belongs to the text that began earlier.
            head = int(edges[0])
            before = int(np.searchsorted(starts, first, side="right")) - 1
            if head:
                sums[before] += table[places[:head]].sum(axis=0, dtype=np.float64)
                counts[before] += head
            if len(held):
                sums[held] += np.add.reduceat(table[places], edges[held], axis=0)
                counts[held] += (edges[1:] - edges[:-1])[held]
    mean = sums / np.maximum(counts, 1)[:, None]
    return _softmax((mean + model.bias) / model.temperature)


def predict_languages(docs: DataFrame, model: Languages, id_column: str = "doc_id", text_column: str = "text",
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, lang_pred, score, rejected) per row, from the whole text alone.

    ``und`` with score 0 for texts that are null or have no letter. A text is rejected if it is
    ``und`` or its probability lies below the model's bound; the prediction is given all the same.
    The model's table has a fixed size times the number of languages and is broadcast. ``keep``
    names columns of ``docs`` to hand through, in a struct ``row``.
    """
    shared, light = docs.sparkSession.sparkContext.broadcast(model.table), model._replace(table=None)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, last in byte_slices(texts, SLICE):
                part = texts[first:last]
                chances = _scores(part, light, table)
                best = chances.argmax(axis=1)
                known = np.array([bool(light.names) and any(map(str.isalpha, t)) for t in part], bool)
                score = np.where(known, chances[np.arange(len(part)), best], 0.0)
                names = [light.names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), pa.array(names, pa.string()), pa.array(score),
                     pa.array(~known | (score < light.least))], names=["key", "lang_pred", "score", "rejected"])

    carried = F.struct(plain(id_column).alias("id"), F.struct(*[plain(c) for c in keep] or [F.lit(0)]).alias("row"))
    rows = docs.select(carried.alias("key"), text_of(text_column).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    found = rows.mapInArrow(predict, f"key {kind}, lang_pred string, score double, rejected boolean")
    return found.select("key.id", "lang_pred", "score", "rejected", *(["key.row"] if keep else []))
