import numpy as np

from tapekeeper.llm import quality
from tapekeeper.llm.queries import op10_quality, table
from tapekeeper.llm.training import Example


def test_ngrams_share_repetition_and_have_length_one():
    of = quality.ngrams()
    a, b = of("foo foo foo"), of("bar bar bar")
    assert len(set(a[0].tolist()) & set(b[0].tolist())) == 1
    assert abs((a[1] ** 2).sum() - 1) < 1e-9 and len(of("")[0]) == 0


def test_ftrl_learns_and_stays_sparse(spark):
    rng, of = np.random.default_rng(0), quality.ngrams()
    words = [f"w{i}" for i in range(300)]

    def text(good):
        return " ".join([*rng.choice(words, 30), *([] if good else ["|", "|"])])

    labels = rng.integers(0, 2, 800)
    rows = [Example(int(y), *of(text(y))) for y in labels]
    model = quality.fit_ftrl(rows)
    assert 2 * np.count_nonzero(quality.fit_ftrl(rows, l1=0.5).weights) < np.count_nonzero(model.weights)
    unseen = rng.integers(0, 2, 200)
    docs = spark.createDataFrame([(i, text(y), 9) for i, y in enumerate(unseen)], "doc_id long, text string, score int")
    assert all((r.score >= 0.5) == bool(unseen[r.id]) for r in quality.score_quality(docs, model).collect())


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (1, "x " * 100_000), (1, "x")], "doc_id long, text string")
    none, ones = quality.fit_ftrl([]), quality.fit_ftrl([Example(1, *quality.ngrams()("good"))] * 20)
    assert {r.score for r in quality.score_quality(docs, none).collect()} == {0.5}
    scores = [r.score for r in quality.score_quality(docs, ones).collect()]
    assert len(scores) == 4 and min(scores) > 0.5
    assert quality.score_quality(docs.limit(0), ones).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    rows = op10_quality(spark, sf).collect()
    assert len(rows) == table(spark, sf, "documents").count()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
