import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from tapekeeper.llm import piece_tokens
from tapekeeper.llm.queries import op9_piece_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", "  a  b ", "ﬁ Ａ①", "a\tb\nc", " ", "a\u0000b", "​x", "▁a ▁▁ b", "\n\n", "\n x", " \n ",
       "漢字かな と🙂", "x" * 5000, " " * 3000, "a" * 49 + " " + "ab" * 60, "é\r\n", " </s><s>", "word " * 30_000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_heap_and_rows_agree_with_the_library(library):
    pieces, rng = piece_tokens.Pieces(MODEL), random.Random(2)
    texts = ODD + ["".join(rng.choice("aeinrst . ,The1é\n") for _ in range(rng.randint(1, 400))) for _ in range(400)]
    for text, ids in zip(texts, pieces.encode(texts)):
        expected = library.encode(text)
        assert list(memoryview(ids).cast("i")) == expected
        chunks = pieces.chunks.findall(" " + text.replace("▁", " ")) if text else []
        if len(text) < 2000:
            assert [i for chunk in chunks for i in pieces.merge(chunk)] == expected
        assert pieces.decode(expected) == library.decode(expected)


def test_decoding_any_ids(library):
    pieces, rng = piece_tokens.pieces_of(MODEL), random.Random(1)
    for _ in range(2000):
        ids = [rng.randrange(0, 400 if rng.random() < .6 else 32000) for _ in range(rng.randrange(0, 12))]
        assert pieces.decode(ids) == library.decode(ids)


def test_check_finds_a_difference():
    pieces = piece_tokens.Pieces(MODEL)
    pieces.known[" word"] = b"\0\0\0\0"
    with pytest.raises(ValueError, match="otherwise"):
        pieces.verify([" word"])


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(piece_tokens, "REMEMBERED", 3)
    monkeypatch.setattr(piece_tokens, "KEPT", 1)
    pieces = piece_tokens.Pieces(MODEL)
    for text in ["one two three four", "two five six", "one seven two", "one two"] * 2:
        assert list(memoryview(pieces.encode([text])[0]).cast("i")) == library.encode(text)


def test_query(spark, sf, library):
    rows = {r.doc_id: r for r in op9_piece_tokens(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "")
        row = rows[d.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, None, 1), (2, "", 1), (2, "a b", 1), (2, "a b", 1)], "doc_id long, text string, ids int")
    rows = piece_tokens.encode_pieces(docs.repartition(2), MODEL).collect()
    assert sorted((str(r.id), len(r.ids), r.decoded) for r in rows) == [("2", 0, ""), ("2", 2, "a b"), ("2", 2, "a b"), ("None", 0, "")]
    assert piece_tokens.encode_pieces(docs.limit(0), MODEL).count() == 0
