"""Scores of the learned operators over whole tables against plain Python, feature by feature."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tapekeeper.llm import langid, quality, toxicity
from tapekeeper.llm.queries import (
    REJECTED_SEVERITY, language_model, op1_toxicity, op4_language_id, op10_quality, table, toxicity_model)
from tests.llm.test_langid import slow_places

MASK = (1 << 64) - 1
ODD = [None, "", " ", "1 2 3", "a", "a a a b a", "Ünï — çødé", "x" * 5000, "one two " * 3000, "\u0000 ", "The the THE."]


def sigmoid(x):
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def crc(word):
    return zlib.crc32(word.encode())


def slow_severity(text, model):
    """(severity, grade): a weight for each distinct place of a word or a word's beginning, then a sigmoid per threshold."""
    names = set()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        names |= {word} | {f"{word[:n]}~" for n in (4, 5) if len(word) >= n}
    weights = dict(zip(model.places.tolist(), model.weights.tolist()))
    score = sum(weights.get(p, 0.0) for p in {crc(n) % (1 << 20) for n in names})
    above = [sigmoid(score - t) for t in model.thresholds.tolist()]
    return sum(above), sum(a >= 0.5 for a in above)


def slow_quality(text, model):
    """Words, pairs and words that come back after one other, as 20-bit places with log counts scaled to length 1."""
    left, right, again = int(quality.LEFT), int(quality.RIGHT), int(quality.AGAIN)
    words = [crc(w) for w in re.findall(r"\w+|[^\w\s]+", text)]
    counts = Counter(w * right & MASK for w in words)
    for a, b in zip(words, words[1:]):
        counts[(again if a == b else (a * left & MASK) ^ (b * right & MASK)) * left & MASK] += 1
    for a, b, c in zip(words, words[1:], words[2:]):
        if a == c != b:
            counts[again * right & MASK] += 1
    places = Counter()
    for code, n in counts.items():
        places[code >> 44] += n
    values = {p: math.log1p(n) for p, n in places.items()}
    length = max(math.sqrt(sum(v * v for v in values.values())), 1e-12)
    return sigmoid(sum(float(model.weights[p]) * v for p, v in values.items()) / length + model.bias)


def slow_language(text, model):
    """(language, probability): the subwords' rows averaged, plus the bias, over the temperature."""
    if text is None or not any(map(str.isalpha, text)):
        return "und", 0.0
    places = slow_places(text)
    mean = [sum(float(model.table[p, k]) for p in places) / max(1, len(places)) for k in range(len(model.names))]
    logits = [(m + float(b)) / model.temperature for m, b in zip(mean, model.bias)]
    top = max(logits)
    parts = [math.exp(x - top) for x in logits]
    return model.names[parts.index(max(parts))], max(parts) / sum(parts)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return table(spark, sf, "documents")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")


def test_severity(spark, sf, docs, odd):
    model = toxicity_model(spark, docs, sf)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = op1_toxicity(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        severity, grade = slow_severity(texts[r.doc_id], model)
        assert r.severity == pytest.approx(severity, abs=1e-9) and r.grade == grade
        assert r.rejected == (severity >= REJECTED_SEVERITY)
    for r in toxicity.score_severity(odd, model).collect():
        assert r.severity == pytest.approx(slow_severity(ODD[r.id] or "", model)[0], abs=1e-9)


def test_quality(spark, sf, docs, odd, monkeypatch):
    fitted, fit = [], quality.fit_ftrl
    monkeypatch.setattr(quality, "fit_ftrl", lambda rows: fitted.append(fit(rows)) or fitted[0])
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = op10_quality(spark, sf).collect()
    model = fitted[0]
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.score == pytest.approx(slow_quality(texts[r.doc_id], model), abs=1e-6)
        assert r.predicted == int(r.score >= 0.5) and r.held_out == (crc(str(r.doc_id)) % 3 == 1)
    for r in quality.score_quality(odd, model).collect():
        assert r.score == pytest.approx(slow_quality(ODD[r.id] or "", model), abs=1e-6)


def test_language(spark, sf, docs, odd):
    model = language_model(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = op4_language_id(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (crc(str(r.doc_id)) % 4 == 2)
    sample = [r for r in rows if r.doc_id % 7 == 0]  # the slow version takes its time
    found = [(texts[r.doc_id], r) for r in sample] + [(ODD[r.id], r) for r in langid.predict_languages(odd, model).collect()]
    for text, r in found:
        name, score = slow_language(text, model)
        assert r.lang_pred == name and r.score == pytest.approx(score, abs=1e-5)
        assert r.rejected == (name == "und" or r.score < model.least)
