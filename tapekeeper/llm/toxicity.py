"""Toxicity as an ordered severity: a cumulative-link regression on the hashed words of a text."""

from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tapekeeper.llm.shared import REMEMBERED, WORDS, WordHashes, plain, sigmoid, text_of
from tapekeeper.llm.training import Example, stacked

# Hash places of words.
PLACES = 1 << 20


class Severity(NamedTuple):
    """Weights shared by all thresholds, for the places that have one, and the ordered thresholds between grades."""

    places: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


# Letters of the word beginnings that are features beside the words, so that other forms of a word count too.
BEGINNINGS = (4, 5)


class WordPlaces(dict):
    """word -> the places of the word and its beginnings, of those in ``among`` if that is given."""

    def __init__(self, among=None):
        super().__init__()
        self.among, self.hashes = among, WordHashes()

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        names = [word, *(f"{word[:n]}~" for n in BEGINNINGS if len(word) >= n)]
        places = {self.hashes[name] % PLACES for name in names}
        self[word] = found = tuple(sorted(places if self.among is None else places & self.among))
        return found


def word_presence():
    """A function from a text to the places of its distinct lower-cased words and their beginnings; every value is 1."""
    places_of = WordPlaces()

    def of(text: str) -> tuple[np.ndarray, np.ndarray]:
        words = set(WORDS.findall(text.lower()))
        found = np.array(sorted(set(chain.from_iterable(map(places_of.__getitem__, words)))), np.int64)
        return found, np.ones(len(found))

    return of


def _associations(row: np.ndarray, place: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """For each place how many standard errors its log odds among positive rows lie above those among the others; 0 if in one row only."""
    n = np.bincount(place, minlength=PLACES)
    a, b = np.bincount(place, positive[row].astype(float), PLACES) + 0.5, np.bincount(place, ~positive[row], PLACES) + 0.5
    c, d = positive.sum() + 1 - a, (~positive).sum() + 1 - b
    return np.where(n > 1, np.log(a * d / (b * c)) / np.sqrt(1 / a + 1 / b + 1 / c + 1 / d), 0)


def telling_places(rows: list[Example], positive: np.ndarray, noise: float = 0.1, draws: int = 3, seed: int = 5) -> np.ndarray:
    """Places of words that are typical of the positive rows.

    How typical is enough depends on how many rows there are. So as many rows are drawn from the others and taken for
    positive, a few times over: the bound is the lowest at which such chance finds are at most a share ``noise`` of the real ones.
    """
    row, place, _ = stacked(rows)
    if not len(place) or positive.all() or not positive.any():
        return np.empty(0, np.int64)
    found = _associations(row, place, positive)
    others, chance = np.nonzero(~positive)[0], []
    number = np.full(len(positive), -1)
    number[others] = np.arange(len(others))
    inside = number[row] >= 0
    rng = np.random.default_rng(seed)
    for _ in range(draws):
        taken = np.zeros(len(others), bool)
        taken[rng.choice(len(others), min(int(positive.sum()), len(others) // 2), replace=False)] = True
        chance.append(np.sort(_associations(number[row[inside]], place[inside], taken)) if taken.any() else np.zeros(1))
    for bound in np.arange(1.5, 20, 0.25):
        wrong = np.mean([len(z) - np.searchsorted(z, bound) for z in chance])
        if wrong <= noise * np.count_nonzero(found >= bound):
            break
    return np.nonzero(found >= bound)[0]


def fit_severity(rows: list[Example], places: np.ndarray, grades: np.ndarray, penalty: float = 1e-4,
                 steps: int = 400, rate: float = 0.1, share: float | None = None) -> Severity:
    """Maximises the penalised likelihood of ordered grades 0, 1, ... by Adam over all rows.

    With ``share``, the known share of rows above grade 0, the rows of grade 0 and the others weigh alike in the fit
    whatever their numbers, and the thresholds are then moved by the log odds of that share.

    P(grade > k) = sigmoid(w x - t_k) with one w for all k and t_0 <= t_1 <= ... Rows are texts'
    sets of words, restricted to ``places``. Without rows, or with a single grade, there is nothing
    to learn: no weights and thresholds that give every text that grade's neighbourhood.
    """
    top = int(grades.max()) if len(grades) else 1
    above, even = np.count_nonzero(grades), share is not None and 0 < np.count_nonzero(grades) < len(grades)
    weight = np.where(grades > 0, 0.5 / max(1, above), 0.5 / max(1, len(grades) - above)) if even else np.full(
        len(grades), 1 / max(1, len(grades)))
    shares = [(weight[grades > k].sum() * len(grades) + 0.5) / (len(grades) + 1) for k in range(max(1, top))]
    t = np.array([np.log((1 - s) / s) for s in shares])
    row, place, _ = stacked(rows)
    at = np.searchsorted(places, place)
    hit = at < len(places)
    hit[hit] = places[at[hit]] == place[hit]
    row, at = row[hit], at[hit]
    params = np.concatenate([np.zeros(len(places)), t])
    first, second, size = np.zeros(len(params)), np.zeros(len(params)), len(places)
    each = np.arange(len(grades))
    for step in range(1, steps + 1 if len(grades) and top else 1):
        w, t = params[:size], params[size:]
        score = np.bincount(row, w[at], len(grades))
        over = np.concatenate([np.ones((len(grades), 1)), sigmoid(score[:, None] - t), np.zeros((len(grades), 1))], axis=1)
        a, b = over[each, grades], over[each, grades + 1]
        p = np.maximum(a - b, 1e-12)
        slope = np.zeros((len(grades), top + 2))
        slope[each, grades] -= a * (1 - a) / p
        slope[each, grades + 1] += b * (1 - b) / p
        gradient = np.concatenate([np.bincount(at, (weight * (1 - a - b))[row], size) - penalty * w,
                                   weight @ slope[:, 1:-1]])
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        params = params + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        params[size:] = np.maximum.accumulate(params[size:])
    moved = np.log((1 - share) / share) if even else 0.0
    return Severity(places, params[:size], params[size:] + moved)


def score_severity(docs: DataFrame, model: Severity, id_column: str = "doc_id", text_column: str = "text",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, severity, grade, above) per row: ``above[k]`` is P(grade > k), severity their sum, grade how many reach a half.

    Whole texts; null and empty texts have no words and get what the thresholds alone say. The
    model is bounded by its training sample, so it travels with the task. ``keep`` names columns of ``docs`` to
    hand through, in a struct ``row``.
    """
    weight = dict(zip(model.places.tolist(), model.weights.tolist()))
    thresholds, grades = model.thresholds, len(model.thresholds)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places_of = WordPlaces(weight.keys())
        for batch in batches:
            totals = []
            for text in batch.column(1):
                words = set(WORDS.findall(text.as_py().lower()))
                totals.append(sum(weight[p] for p in set(chain.from_iterable(map(places_of.__getitem__, words)))))
            above = sigmoid(np.array(totals, np.float64).reshape(-1, 1) - thresholds)
            ends = np.arange(0, above.size + 1, grades, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above.sum(axis=1)), pa.array((above >= 0.5).sum(axis=1).astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(above.ravel()))],
                names=["key", "severity", "grade", "above"])

    carried = F.struct(plain(id_column).alias("id"), F.struct(*[plain(c) for c in keep] or [F.lit(0)]).alias("row"))
    rows = docs.select(carried.alias("key"), text_of(text_column).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    scored = rows.mapInArrow(score, f"key {kind}, severity double, grade int, above array<double>")
    return scored.select("key.id", "severity", "grade", "above", *(["key.row"] if keep else []))
