import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tapekeeper.llm import langid, toxicity
from tapekeeper.llm.queries import REJECTED_SEVERITY, language_model, table, toxicity_model
from tapekeeper.llm.shared import written
from tests.llm.test_simhash import brute_components, plain_fingerprint

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows after each stage, by the stages themselves."""
    docs, out = table(spark, SF, "documents"), []
    for name, step in corpus_pipeline.STAGES:
        docs = written(step(spark, docs, SF), name)
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def test_toxicity_stage(spark, steps):
    docs = table(spark, SF, "documents")
    model = toxicity_model(spark, docs, SF)
    weight, of = dict(zip(model.places.tolist(), model.weights)), toxicity.word_presence()
    keep = set()
    for d, t in texts(docs).items():
        score = sum(weight.get(p, 0.0) for p in of(t)[0].tolist())
        if sum(1 / (1 + np.exp(b - score)) for b in model.thresholds) < REJECTED_SEVERITY:
            keep.add(d)
    assert set(texts(steps[0])) == keep and steps[0].columns == docs.columns
    assert 0.5 * docs.count() < len(keep) < docs.count()


def test_language_stage(spark, steps):
    model, of, keep = language_model(steps[0]), langid.subwords(), set()
    for d, t in texts(steps[0]).items():
        places, shares = of(t)
        x = (shares @ model.table[places] + model.bias) / model.temperature
        chance = np.exp(x - x.max()) / np.exp(x - x.max()).sum()
        if any(map(str.isalpha, t)) and chance.max() >= model.least:
            keep.add(d)
    assert set(texts(steps[1])) == keep and len(keep) > 0.98 * steps[0].count()


def test_exact_stage(steps):
    best = {}
    for d, t in texts(steps[1]).items():
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        best[low] = max(best.get(low, d), d)
    assert set(texts(steps[2])) == set(best.values())


def test_near_stage(steps):
    prints = [(d, plain_fingerprint(t)) for d, t in texts(steps[2]).items()]
    assert set(texts(steps[3])) == set(brute_components(prints, 4).values())


def test_packing_stage_and_run(spark, steps):
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder.encode_special_tokens = True
    sizes = {d: len(coder.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts(steps[3]).items()}
    rows = steps[4].collect()
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        assert r.doc_tokens == sizes[r.doc_id]
    assert got == sizes
    whole = corpus_pipeline.run(spark, SF)
    total = lambda df: sorted((r.doc_id, r.doc_tokens) for r in df.select("doc_id", "doc_tokens").distinct().collect())
    assert total(whole) == total(steps[4])


def test_empty_tables_and_odd_rows_pass_through(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(None, None, "en", None, None), (1, "", None, "s", 0), (2, "a word of text", "en", "s", 14),
                                  (2, "a word of text", "en", "s", 14)], table(spark, SF, "documents").schema)
    for rows in (docs.limit(0), docs):
        for name, step in corpus_pipeline.STAGES:
            rows = written(step(spark, rows, str(tmp_path)), name)
        rows.collect()
    assert {r.doc_id for r in rows.collect()} <= {1, 2}
