"""The piece codec against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from tablegate.llm import pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "  \n", "▁", "a▁b", " ▁ a", "é ß 日本 😀", "x" * 5000, "word " * 3000, "a  b   c    d", "<s> </s> <unk> <0x0A>", "\x00a", " ⁇ "]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(MODEL)


def texts_of(library, n: int) -> list[str]:
    """Random characters, and random pieces side by side, so that merges compete."""
    r = random.Random(5)
    vocabulary = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.vocab_size())]
    letters = "ab ▁  \n1é日😀.<>_0x"
    found = ["".join(r.choice(letters) for _ in range(r.randrange(1, 40))) for _ in range(n)]
    return found + ["".join(r.choice(vocabulary) for _ in range(r.randrange(1, 12))) for _ in range(n)]


def test_ids_and_texts_are_the_librarys(library, model):
    for text in [t or "" for t in ODD] + texts_of(library, 1500):
        ids, want = np.frombuffer(model.encode(text), "<u4"), library.encode(text)
        assert ids.tolist() == want
        assert model.decode(ids) == library.decode(want)


def test_whole_agenda_without_parts(library, model):
    """The agenda over a whole text gives what the parts give."""
    for text in texts_of(library, 300):
        assert model.merge("▁" + text.replace(" ", "▁")) == library.encode(text)


def test_ids_that_no_text_has(library, model):
    r = random.Random(6)
    # Unknown and control ids, spaces and broken bytes in any place.
    pool = [0, 1, 2, 35, 229, 153, 259, 300, 29871, *range(3, 260, 9)]
    for _ in range(2000):
        ids = [r.choice(pool) for _ in range(r.randrange(0, 6))]
        assert model.decode(np.array(ids, np.int64)) == library.decode(ids)


def test_documents(spark, library):
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_sentencepiece"](spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids, r = library.encode(d["text"] or ""), got.pop(d["doc_id"])
        assert r["agrees"] and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert not got


def test_rows_pass_through(spark, library):
    rows = [(i, t, i) for i, t in enumerate(ODD)] + [(3, ODD[3], 3), (None, "no id", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens int").selectExpr("*", "1 AS ids", "2 AS agrees")
    got = pieces.encoded(docs, MODEL)
    assert got.columns == ["doc_id", "ids", "agrees", "tokens"]
    want = sorted(((i, library.encode(t or "")) for i, t, _ in rows), key=str)
    assert sorted(((r["doc_id"], r["tokens"]) for r in got.collect()), key=str) == want
    back = sorted(((r["doc_id"], r["text"]) for r in pieces.decoded(got, MODEL).collect()), key=str)
    assert back == sorted(((i, library.decode(library.encode(t or ""))) for i, t, _ in rows), key=str)
    assert pieces.token_digests(docs, MODEL).count() == len(rows)
    assert pieces.token_digests(docs.limit(0), MODEL, check=True).count() == 0
    nulls = spark.createDataFrame([(1, None)], "doc_id long, tokens array<int>")
    assert pieces.decoded(nulls, MODEL).first()["text"] == ""


def test_other_models_are_refused(tmp_path):
    bad = tmp_path / "model"
    bad.write_bytes(b"")
    with pytest.raises(ValueError, match="no vocabulary of merges"):
        pieces.Pieces(str(bad))


def test_the_check_finds_wrong_words(library):
    own = pieces.Pieces(MODEL)
    agree = pieces._agreement(own, MODEL)
    right = own.merge_together
    own.merge_together = lambda parts: [b"none" if p == "▁word" else x for p, x in zip(parts, right(parts))]
    texts = ["a word", "no more", "word again", "two  words", "two  spaces"]

    def checked(some):
        return agree(some, *own.encode_all(some))

    # Neither a word that is known from before nor one within the batch hides a difference.
    assert checked(texts) == [False, True, False, True, True]
    assert checked(texts[2:]) == [False, True, True]
    assert checked(["", "two word"]) == [True, False]


def test_a_small_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "_CACHE", 20)
    own, texts = pieces.Pieces(MODEL), texts_of(library, 200)
    for at in range(0, len(texts), 7):
        found, _ = own.encode_all(texts[at : at + 7])
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == library.encode(texts[at : at + 7])
