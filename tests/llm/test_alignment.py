"""Alignment of tokens against a plain statement with the two libraries."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tablegate.llm import alignment, queries
from tablegate.llm.alignment import Fragment, Stream

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
_r = random.Random(3)
ODD = [
    None, "", " ", "  \n", "▁", "a▁b and more of it " * 20, "é ß 日本 😀", "x" * 700, "word " * 300, "a  b   c    d",
    "<s> </s> <unk> <0x0A>", "a<|endoftext|>b", "\x00a", "1234 5678 12.5%", "日本語のテキスト" * 60,
    " ".join("".join(_r.choice("abcdeéß日1,\n　") for _ in range(_r.randrange(0, 9))) for _ in range(400)),
    "".join(_r.choice("abcdeéß日1,.-") for _ in range(900)), "one two", "one two",
]


def brute(rows: list[tuple]) -> list[tuple]:
    """Token by token: groups, links, corpus counts."""
    tokenizer, library = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    tokenizer.encode_special_tokens = True
    letters = {c: bytes([i]) for c, i in alignment.bpe._byte_letters().items()}
    every = []
    for doc_id, text in rows:
        a = tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = library.encode(text or "")
        raw_a = [b"".join(letters[c] for c in tokenizer.id_to_token(i)) for i in a]
        pieces = [library.id_to_piece(i) for i in b]
        raw_b = [bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        whole = (" " + text).encode() if text else b""
        if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            a, b, raw_a, raw_b = [], [], [], []
        ends_a, ends_b = np.cumsum([*map(len, raw_a)]).tolist(), np.cumsum([*map(len, raw_b)]).tolist()
        links, groups, held_a, held_b = [], [], [], []
        for i, (x, end) in enumerate(zip(a, ends_a)):
            for j, (y, other) in enumerate(zip(b, ends_b)):
                if end - len(raw_a[i]) < other and other - len(raw_b[j]) < end:
                    links.append((x, y))
        for end in sorted({*ends_a, *ends_b}):
            held_a += [x for x, e in zip(a, ends_a) if e == end]
            held_b += [y for y, e in zip(b, ends_b) if e == end]
            if end in ends_a and end in ends_b:
                groups.append(",".join(map(str, held_a)) + "|" + ",".join(map(str, held_b)))
                held_a, held_b = [], []
        every.append((doc_id, a, b, groups, links))
    counts = Counter(x for *_, links in every for x in links)
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (
            doc_id, len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for doc_id, a, b, groups, links in every
    ]


def found(df) -> list[tuple]:
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


@pytest.mark.parametrize("width, fan, block", [(1 << 16, 16, 1 << 23), (16, 2, 40), (200, 3, 3000)])
def test_any_ranges_give_the_same(spark, width, fan, block):
    """Texts in one range each, and in ranges that cut tokens, groups and words, composed in many steps."""
    rows = [*enumerate(ODD), (3, ODD[3]), (15, ODD[15]), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS at", "3 AS n_a", "4 AS block")
    assert found(alignment.aligned(docs.repartition(3), A, B, width, fan, block)) == sorted(brute(rows), key=str)


def test_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 1500").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(alignment.aligned(docs, A, B, 1 << 10)) == sorted(brute(rows), key=str)


def test_query_does_not_depend_on_ranges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(queries.QUERIES["op13_align_tokens"](spark, SF)) == found(alignment.aligned(docs, A, B, 5000, 4, 1 << 18))


def test_empty_table(spark):
    assert found(alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), A, B)) == []


def test_composition_is_associative():
    r = random.Random(8)
    for _ in range(300):
        n = r.randrange(8, 60)
        ends = [sorted({*r.sample(range(1, n), r.randrange(1, 6)), n}) for _ in "ab"]
        whole = Stream(*(np.array(x) for e in ends for x in ([r.randrange(99) for _ in e], e)))
        cuts = [0, *sorted(r.sample(range(1, n), 3)), n]
        made = [alignment.fragment(whole.between(x, y), x == 0) for x, y in zip(cuts, cuts[1:])]
        closed = [c.arrays() for _, c, _ in made if len(c.a)]

        def joined(x: Fragment, y: Fragment, held: list) -> Fragment:
            out, group = alignment.compose(x, y)
            return held.append(group.arrays()) or out if group is not None else out

        f = [x[0] for x in made]
        left, right = [], []
        one = joined(joined(joined(f[0], f[1], left), f[2], left), f[3], left)
        two = joined(f[0], joined(f[1], joined(f[2], f[3], right), right), right)
        plain = lambda groups: sorted([[y.tolist() for y in x] for x in groups + closed], key=lambda x: x[1])
        assert plain(left) == plain(right)
        assert one.cut == two.cut == n and not len(one.head.a) and not len(one.tail.a)
        flat = [sum((x[i] for x in plain(left)), []) for i in range(4)]
        assert flat == [x.tolist() for x in whole.arrays()]


def test_words_are_remembered_in_two_generations(monkeypatch):
    """Texts cut at safe spaces have the tokens of whole texts, whatever is remembered of texts before."""
    monkeypatch.setattr(alignment, "_WORDS", 30)
    tokens = alignment.Tokens(A, B)
    fresh_a, fresh_b = alignment.bpe.Codec(A), alignment.Pieces(B)
    fresh_a.stop = None
    r = random.Random(5)
    odd = [" " + t for t in ODD if alignment.has_tokens(t)]
    odd += [" " + "".join(r.choice(["a", "the", "é.", " ", " ", "  ", "\n", "\t ", "\u3000", "x1"]) for _ in range(60)) for _ in range(200)]
    for k in range(40):
        texts = ["", *r.sample(odd, r.randrange(0, 9)), *(odd if k == 20 else [])]
        found = tokens.laid_out(texts, [len(t.encode()) for t in texts])
        a = b"".join(map(fresh_a.encode, texts))
        b = b"".join(fresh_b.encode_all(texts, as_is=True)[0])
        assert found.a.tolist() == np.frombuffer(a, "<u4").tolist() and found.b.tolist() == np.frombuffer(b, "<u4").tolist()
        assert all(len(w) <= 64 for w in [*tokens._words, *tokens._before])
        assert len(tokens._words) <= 30 and len(tokens.a.words) <= 30 and len(tokens.a.fits) <= 30
        assert not tokens.a.known and not tokens.b._words and not tokens.b._others


def test_a_worker_holds_few_words_and_small_blocks(spark, monkeypatch):
    """A task over very many distinct words, most of which are met once."""
    monkeypatch.setattr(alignment, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    r = random.Random(7)

    def batches():
        for k in range(12):
            texts = [" ".join("".join(r.choices("abcdefghij", k=6)) for _ in range(500)) for _ in range(100)]
            yield pa.RecordBatch.from_pydict({"key": range(100 * k, 100 * k + 100), "doc_id": range(100), "text": texts})

    run = alignment._whole_blocks((A, B), alignment._schema(spark), alignment.BLOCK)
    alignment._tokens(A, B)
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        rows = sum(batch.num_rows for batch in run(batches()))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most - before < 180 << 20
    assert rows > 1


def test_rows_come_to_workers_in_short_batches(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit, None)
    spark.conf.unset(limit)
    try:
        alignment.aligned(spark.createDataFrame([(1, "one two")], "doc_id long, text string"), A, B)
        assert spark.conf.get(limit) == "4194304b"
        spark.conf.set(limit, "1m")
        alignment.aligned(spark.createDataFrame([(1, "one two")], "doc_id long, text string"), A, B)
        assert spark.conf.get(limit) == "1m"
    finally:
        spark.conf.set(limit, before) if before else spark.conf.unset(limit)
