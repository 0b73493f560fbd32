"""Operators on small tables against brute force, with nulls, repeats, ties, empty tables and clashing columns."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from check_oracle import canonical, connect
from tablegate.llm import bpe, chunks, embeddings, fingerprints, frames, language, mixing, oracle, pii, toxicity, warc
from tablegate.llm.signature_tree import Groups

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", "  \n", "one", "One two", "é ß 日本 😀", "x" * 5000, "word " * 3000, "a<|endoftext|>b", "12 +1 (988) 555-2485 a@b.co"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s") for i, t in enumerate(ODD)]
    rows += [rows[4], (4, "other text", "de", "s"), (None, "no id", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def clash(df):
    """With columns of names the operators use themselves."""
    return df.selectExpr("*", *[f"1 AS {c}" for c in ("size", "k", "n", "d", "h", "score", "tokens", "target", "bucket", "spans", "key")])


def empty(df):
    return df.limit(0)


# --- mixing -------------------------------------------------------------------------------


def test_mix_matches_sql(spark, docs):
    query = mixing.mixed(docs)
    want = connect(SF).execute(oracle.mix())
    names = [d[0] for d in want.description]
    assert canonical([tuple(r) for r in query.collect()], query.columns) == canonical(want.fetchall(), names)


def test_mix_keeps_its_targets(docs):
    rows = mixing.mixed(docs, block_words=16, shard_words=2000).collect()
    taken, by = defaultdict(int), {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        by[r["source"]] = r
    for s, r in by.items():
        assert abs(taken[s] - r["target"]) <= 16 * (2 + r["source_size"] / 1000)
        assert r["target"] <= 2 * r["source_size"]
    assert math.isclose(sum(r["target"] for r in by.values()), 1.5 * sum(r["source_size"] for r in by.values()))


def test_highest_quotients(spark):
    weights = {"a": 53, "b": 24, "c": 23, "d": 1, "e": 0}
    parties = spark.createDataFrame(list(weights.items()), "p string, w long").selectExpr("0 AS g", "*")
    for seats in (1, 2, 7, 10, 100, 101):
        got = {r["p"]: r["quota"] for r in mixing.apportion(parties, ["g"], "p", "w", mixing.F.lit(seats)).collect()}
        best = sorted(((-w / (2 * k + 1), p) for p, w in weights.items() for k in range(seats) if w))[:seats]
        assert got == {p: sum(x[1] == p for x in best) for p in weights}


def test_mix_of_odd_rows(spark, odd):
    rows = mixing.mixed(clash(odd)).collect()
    assert len(rows) == odd.count()
    sizes = sorted(len(WORD.findall(r["text"] or "")) for r in odd.collect())
    assert sorted(r["size"] for r in rows) == sizes and all(r["taken"] == 0 for r in rows if not r["size"])
    assert mixing.mixed(empty(odd)).collect() == []
    assert sorted(map(str, mixing.mixed(odd.repartition(7)).collect())) == sorted(map(str, rows))


# --- BPE ----------------------------------------------------------------------------------


def test_bpe_equals_the_library(spark, odd):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, codec = Tokenizer.from_file(path), bpe.codec(path)
    rng = random.Random(3)
    alphabet = ["a", "e", "th", "he", " ", "  ", "\n", "é", "1", "'s", "!", "$$", "the", "ing", "\t", "日", " \n", " the", "<|endoftext|>", "\x1c", "　"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(800)]
    texts += [t or "" for t in ODD] + ["ab" * 2000, "aelnrst" * 500, "\r\n \t x"]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        ids = np.frombuffer(codec.encode(text), "<u4")
        assert ids.tolist() == want, text
        assert bpe.text_of(codec.decode(ids)).decode() == library.decode(want, skip_special_tokens=False)
    got = bpe.token_digests(clash(odd), path).collect()
    want = []
    for r in odd.collect():
        e = library.encode(r["text"] or "", add_special_tokens=False).ids
        back = library.decode(e, skip_special_tokens=False).encode()
        want.append((r["doc_id"], len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256(back).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert bpe.token_digests(empty(odd), path).collect() == []
    rows = bpe.encoded(clash(odd), path)
    assert rows.where("not round_trip").count() == 0 and rows.count() == odd.count()
    texts = bpe.decoded(rows, path).collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in texts) == sorted(str((r["doc_id"], r["text"] or "")) for r in odd.collect())


# --- embeddings ---------------------------------------------------------------------------


def near_brute(rows):
    units = [None if r[2] is None else embeddings.unit(r[1]) for r in rows]
    groups, links = Groups(len(rows)), [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            same = rows[i][2] == rows[j][2] and None not in (rows[i][0], rows[j][0])
            if a is not None and b is not None and same and len(a) == len(b) and a @ b >= 0.93:
                groups.join(i, j)
                links[i] += 1
                links[j] += 1
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[groups.find(i)] = min(least.get(groups.find(i), r[0]), r[0])
    comp = [None if r[0] is None else least[groups.find(i)] for i, r in enumerate(rows)]
    return sorted(((r[0], n, c, c is not None and c == r[0]) for r, n, c in zip(rows, links, comp)), key=str)


@pytest.mark.parametrize("block", [1024, 5])
def test_embeddings_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "PER_PIVOT", 20)
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((6, 8))
    rows = []
    for i in range(150):
        x = centers[i % 6] + rng.standard_normal(8) * (0.05 if i % 5 == 0 else 0.4)
        rows.append((i, [float(v) for v in x.astype(np.float32)], i % 3))
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 1), (0, rows[0][1], 0), (202, [2 * v for v in rows[3][1]], 0)]
    rows += [(300, None, 0), (301, [], 0), (302, [0.0] * 8, 0), (303, [float("nan")] + [1.0] * 7, 0), (304, [None] + [1.0] * 7, 0)]
    rows += [(305, [1.0, 2.0], 0), (306, [1.0, 2.1], 0), (307, rows[0][1], None), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = embeddings.near_duplicates(clash(df)).collect()
    assert sorted(map(tuple, got), key=str) == near_brute(rows)
    assert embeddings.near_duplicates(empty(df)).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 64))
    x[150:] = x[:150] + rng.standard_normal((150, 64)) * 0.2
    x /= np.linalg.norm(x, axis=1)[:, None]
    bits, factors = embeddings.codes(x)
    assert (embeddings.upper_bounds(bits, factors, x) >= x @ x.T - 1e-9).all()


# --- chunks -------------------------------------------------------------------------------


def test_chunks_resist_insertions():
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(20_000))
    one, two = chunks.ends([text, b"some words first " + text])
    assert len(set(one) & {e - 17 for e in two.tolist()}) >= len(one) - 3
    assert [len(e) for e in chunks.ends([b"", b"a", b"zz" * 3])] == [0, 1, 1]


def test_repeated_passages(spark, odd):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    passage = " ".join(word() for _ in range(55))
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 300)))) for i in range(40)]
    planted = {3, 7, 20}
    rows = [(i, f"{t[: len(t) // 2]} {passage} {t[len(t) // 2 :]}" if i in planted else t) for i, t in rows]
    rows += [(50, passage + " " + passage), (51, None), (None, passage), rows[3]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = chunks.repeated_passages(clash(df)).collect()
    assert {r["doc_id"] for r in got} == planted | {50}
    assert {r["first_doc_id"] for r in got} == {3}
    texts = dict(rows)
    for r in got:
        assert texts[r["doc_id"]].encode()[r["begin"] : r["stop"]].decode().strip() in f"{passage} {passage}"
    assert chunks.repeated_passages(empty(df)).collect() == []
    assert chunks.repeated_passages(odd.dropDuplicates(["text"])).collect() == []


def _random_words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_stitched_chunks_are_no_passage(spark):
    """A document of pieces that each stand in another document holds no passage of any of them."""
    rng = random.Random(12)
    others = [_random_words(rng, 300).encode() for _ in range(12)]
    # Pieces of a few whole chunks, a new one of each document in turn.
    stops = [s.tolist() for s in chunks.ends(others)]
    text = b"".join(others[k % 12][stops[k % 12][k] : stops[k % 12][k + 2]] for k in range(48))
    rows = [(k, t.decode()) for k, t in enumerate([*others, text])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert chunks.repeated_passages(df).collect() == []
    # Every reported byte lies in enough words that another place holds.
    rows += [(20, others[3].decode()[200:900]), (21, others[3].decode()[500:1200])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = chunks.repeated_passages(df).collect()
    assert {r["doc_id"]: r["first_doc_id"] for r in got} == {3: 3, 20: 3, 21: 3}
    for r in got:
        raw = dict(rows)[r["doc_id"]].encode()[r["begin"] : r["stop"]]
        assert raw in others[3] and r["n_words"] >= 20 and len(raw) > (1150 - 200 if r["doc_id"] == 3 else 600)


def test_repeats_are_dropped_but_for_the_first(spark):
    rng = random.Random(13)
    one, two, own = (_random_words(rng, 60) for _ in range(3))
    fill = [_random_words(rng, 40) + " é日 " for _ in range(9)]
    rows = [(1, fill[0] + one + fill[1]), (2, fill[2] + one + fill[3] + two), (3, fill[4] + own + fill[5] + own + fill[6])]
    rows += [(4, two), (5, None), (None, one), (6, fill[7]), (6, fill[8] + one)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS begin", "2 AS spans")
    out = chunks.without_repeats(df)
    assert out.columns == df.columns
    new = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    old = dict(rows[:4])
    got = dict(x for x in new if x[0] in old)
    assert got[1] == old[1] and len(got[4]) < 60 and got[2].endswith(two) and fill[2][:200] in got[2] and fill[3][40:] in got[2]
    assert len(got[2]) < len(old[2]) - len(one) + 90 and got[3].count(own) == 1 and len(got[3]) < len(old[3]) - len(own) + 90
    assert [x for x in new if x[0] in (5, None, 6)] == sorted([x for x in rows if x[0] in (5, None, 6)], key=str)
    drops = {(r["doc_id"], r["begin"], r["stop"]) for r in chunks.spans_to_drop(df).collect()}
    said = {(r["doc_id"], *map(int, x.split(":"))) for r in chunks.repeated_passages(df).collect() for x in r["drops"].split(",") if x}
    assert drops == said and {d for d, _, _ in drops} == {2, 3, 4, 6}


def test_equal_windows_are_merged_where_they_are_sorted(spark):
    """Repeated rows of a document give its windows once, without a shuffle of all shared windows for it."""
    rng = random.Random(5)
    one = _random_words(rng, 90)
    docs = spark.createDataFrame([(1, one), (2, one), (1, one), (2, one), (1, one)], "doc_id long, text string")
    shared = chunks.shared_windows(docs)
    got = [tuple(r) for r in shared.collect()]
    assert got and len(got) == len(set(got)) and {r[0] for r in got} == {1, 2}
    assert "Aggregate" not in shared._jdf.queryExecution().optimizedPlan().toString()
    assert chunks.repeated_passages(docs.where("doc_id = 1")).count() == 0


def test_words_are_parted_by_any_white_space(spark):
    rng = random.Random(14)
    words = _random_words(rng, 60).split()
    few = _random_words(rng, 12).split()
    for gap in ("\t", "\f", "\r", " \n", "\v"):
        rows = [(i, f"{_random_words(rng, 9)}{gap}{gap.join(words)}{gap}{_random_words(rng, 9)}") for i in (1, 2)]
        got = chunks.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert len(got) == 2 and all(40 < r["n_words"] <= 60 for r in got)
    rows = [(i, "   ".join(few)) for i in (1, 2)]
    assert chunks.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect() == []


def test_shared_chunks_are_streamed():
    digest = np.repeat([1, 2, 3, 4], [3, 700, 1, 50])
    doc = np.concatenate([[5, 5, 5], np.arange(700) // 2, [9], np.full(50, 8)])
    zero = np.zeros(len(doc), np.int32)
    table = pa.table({"digest": digest, "doc_id": doc, "begin": zero, "stop": zero, "words": zero})
    for size in (1, 7, 1000):
        got = pa.Table.from_batches(chunks._shared(iter(table.to_batches(size)))).to_pydict()
        assert got["doc_id"] == doc[digest == 2].tolist() and set(got["first_doc_id"]) == {0}


# --- WARC ---------------------------------------------------------------------------------


def warc_brute(rows):
    largest = {}
    for i, _, h in rows:
        if i is not None:
            largest[h or ""] = max(largest.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw, top = (h or "").encode(), largest.get(h or "")
        first = i is None or i == top
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), sha, "response" if first else "revisit", None if first else top))
    return sorted(out, key=str)


def test_archives_give_back_what_was_written(spark):
    rng = random.Random(1)
    rows = [(i, "http://x/ y\n", rng.choice(["", "a", None, "b" * 1000, "é"])) for i in range(30)]
    rows += [(100, None, "".join(chr(rng.randint(32, 0xD000)) for _ in range(300_000))), (101, "u", "z" * 17_000_000)]
    rows += [rows[3], (7, "u", "other"), (None, "u", "a"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = warc.archived(clash(df)).drop("url").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(tuple, got), key=str) == warc_brute(rows)
    assert warc.archived(empty(df)).collect() == []


def test_magic_inside_members_and_cut_files(spark, tmp_path):
    """Stored blocks that hold the magic: pieces are joined, also over the ends of byte ranges."""
    import gzip
    import zlib

    rng = random.Random(5)
    payloads = [bytes(rng.randrange(256) for _ in range(400)) + warc.MAGIC * rng.randint(0, 3) + bytes(300) for _ in range(300)]
    raw = b""
    for i, payload in enumerate(payloads):
        packer = zlib.compressobj(0, zlib.DEFLATED, 31)
        raw += packer.compress(warc.record(i, "u", payload, None)) + packer.flush()
    assert gzip.decompress(raw).count(b"WARC/1.1") == 300
    (tmp_path / "a").mkdir()
    (tmp_path / "a/part-0").write_bytes(raw)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1537")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {r["page_id"]: r["payload_digest"] for r in warc.read(spark, str(tmp_path / "a")).collect()}
        assert got == {i: warc.digest(p) for i, p in enumerate(payloads)}
        (tmp_path / "a/part-0").write_bytes(raw[:-100])
        with pytest.raises(Exception, match="belong to no record|does not end"):
            warc.read(spark, str(tmp_path / "a")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


# --- fingerprints -------------------------------------------------------------------------


def shingle_set(text):
    w = WORD.findall(text.lower())
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_fingerprints_estimate_jaccard(docs):
    got = {r["doc_id"]: r for r in fingerprints.compared_with_edits(docs).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    ids, off = sorted(texts), []
    for k, i in enumerate(ids):
        text, after = texts[i], texts[ids[(k + 1) % len(ids)]]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in (("near_edited", edited), ("near_next", after)):
            a, b = shingle_set(text), shingle_set(other)
            off.append(r[near] - len(a & b) / max(1, len(a | b)))
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.05 and np.abs(off).max() < 0.2


def test_fingerprints_of_odd_rows(spark, odd):
    got = fingerprints.compared_with_edits(clash(odd)).collect()
    assert len(got) == odd.count()
    by_text = {r["text"]: r["doc_id"] for r in odd.collect()}
    prints = defaultdict(set)
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints[r["doc_id"]].add(r["fingerprint"])
    assert prints[by_text[""]] == {""} and len(next(iter(prints[by_text["one"]]))) == 2 * fingerprints.BINS
    assert fingerprints.compared_with_edits(empty(odd)).collect() == []
    alone = fingerprints.compared_with_edits(odd.where("doc_id = 3")).collect()[0]
    assert alone["near_next"] == 1.0


# --- language -----------------------------------------------------------------------------


def test_language_of_held_out_documents(docs):
    got = {r["doc_id"]: r for r in language.languages(docs).collect()}
    right = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in docs.collect() if got[r["doc_id"]]["held_out"]]
    assert len(right) > 20 and np.mean(right) >= 0.95


def test_number_characters_are_no_letters(spark, docs):
    """The words are runs of characters of the Unicode categories of letters."""
    import unicodedata

    letters = {chr(c) for c in range(0x30000) if unicodedata.category(chr(c))[0] == "L"}
    assert {chr(c) for c in range(0x30000) if language._LETTERS.fullmatch(chr(c))} == letters
    texts = [(1, "½ ²"), (2, "Ⅷ"), (3, "12 ٣ ①"), (4, "_ – !"), (5, "Ⅷa")]
    got = language.identified(spark.createDataFrame(texts, "doc_id long, text string"), language.fit(docs)).collect()
    assert {r["doc_id"] for r in got if r["lang_pred"] == language.UNKNOWN} == {1, 2, 3, 4}


def test_language_mixture_and_odd_rows(spark, docs, odd):
    model = language.fit(docs)
    english = docs.where("lang = 'en' and length(text) > 1000").first()["text"]
    german = docs.where("lang = 'de' and length(text) > 1000").first()["text"]
    both = english[:1000] + " " + german[:500]
    (name,), (score,) = language.predict(model, [both])
    assert name == "en" and 0.5 < score < 0.85
    got = language.identified(clash(odd), model).collect()
    assert len(got) == odd.count()
    for r in got:
        unknown = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == unknown and 0 <= r["score"] <= 1
    assert language.languages(empty(odd)).collect() == []
    nothing = language.languages(odd.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


# --- toxicity -----------------------------------------------------------------------------


def test_toxic_words_are_found(spark, odd):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows, labels = [], []
    for i in range(400):
        w = [word() for _ in range(rng.randint(5, 120))]
        if i % 5 == 0:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["zounds", "zooks", "zany"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*labels, (5, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(clash(docs), clash(labels)).collect()}
    texts = dict(rows)
    assert all(r["predicted"] == int(i % 5 == 0) for i, r in got.items())
    for i, r in got.items():
        assert all(texts[i][s["begin"] : s["stop"]].split()[0] in ("zounds", "zooks", "zany") for s in r["spans"])
        assert bool(r["spans"]) == (i % 5 == 0)
    scored = toxicity.scored(clash(odd), toxicity.fit(docs, labels)).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] < 0.7 for r in scored)
    assert toxicity.toxicity(empty(docs), labels).collect() == []
    assert len({r["score"] for r in toxicity.toxicity(docs, empty(labels)).collect()}) == 1


def test_chain_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    model = toxicity.Model({}, rng.normal(size=(3, 4)), rng.normal(size=(2, 2)), rng.normal(size=2))
    kinds = rng.integers(0, 4, (1, 6)).astype(np.int8)
    size = 5
    total, marked = 0.0, np.zeros(size)
    for states in np.ndindex(*(2,) * size):
        score = model.start[states[0]]
        for t, s in enumerate(states):
            if s:
                before = kinds[0, t - 1] if t else 0
                score += model.emit[0][before] + model.emit[1][kinds[0, t]] + model.emit[2][kinds[0, t + 1]]
            score += model.move[states[t - 1], s] if t else 0.0
        total += np.exp(score)
        marked += np.exp(score) * np.array(states)
    assert np.allclose(toxicity.marginals(model, kinds, np.array([size]))[0], marked / total)


# --- personal data ------------------------------------------------------------------------


def strict_brute(text):
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and pii.luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
    ]
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m[0]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    parts = ["a", "@", "b.c", ".", "+", "1", "22", "255", " ", "-", "(", "x@y.z", "é", "_", "+1 ", "0.0.0.0", "٣", "4111111111111111"]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        assert pii.strict(text) == strict_brute(text), text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_personal_data_of_odd_rows(spark, docs, odd):
    for df in (clash(odd), docs):
        got = pii.detected(df).collect()
        want = []
        for r in df.select("doc_id", "text").collect():
            base = strict_brute(r["text"] or "")
            counts = [sum(s[1] == k for s in base) for k in range(4)]
            want.append((r["doc_id"], *counts, hashlib.sha256(pii.written(base).encode()).hexdigest()))
        assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert pii.detected(empty(odd)).collect() == []


def test_trees_add_what_looks_alike():
    """Numbers that fail a check but stand where the others stand are added, and only those."""
    rng = random.Random(2)
    texts, x, y = [], [], []
    for _ in range(600):
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        good = next(d for d in "0123456789" if pii.luhn(digits + d))
        real = rng.random() < 0.5
        text = f"card {digits}{good} end" if real else f"code-{digits[:13]} end"
        texts.append(text)
        for s in pii.proposed(text):
            x.append([float(v) for v in pii.features(text, *s)])
            y.append(s in set(pii.strict(text)))
    x, y = np.array(x), np.array(y, float)
    trees = pii.Trees().fit(x, y)
    assert ((trees.predict(x) > 0.5) == y).mean() > 0.97
    model = pii.Model(trees, (2.0, 2.0, 0.9, 2.0))
    base, every = pii.spans(model, ["card 4111111111111112 end", "code-4111111111111 end", ""])
    assert base[0] == [] and every[0] == [(5, 2, 21)] and every[1:] == [[], []]
    assert pii.redacted("card 4111111111111112 end", every[0]) == "card <CARD> end"


def _sentences(rng, i):
    """Base spans in their contexts, the same contexts with obscured ones, and numbers that are no phones."""
    d = lambda n: "".join(rng.choice("23456789") for _ in range(n))
    phone, name = f"{d(3)}-{d(3)}-{d(4)}", f"{rng.choice('abcdef')}{d(3)}"
    yield f"please call {'' if i % 4 == 0 else '+1 '}{phone} before noon"
    yield f"write to {name}{' [at] host [dot] com' if i % 4 == 1 else '@host.com'} about it"
    yield f"see part {d(3)}-{d(3)}-{d(4)} in stock {d(3)} boxes"


@pytest.mark.parametrize("documents", [12, 400])
def test_fit_adds_obscured_spans(spark, documents):
    """Also on a table with fewer base spans than a threshold of its own needs; numbers in other contexts stay."""
    rng = random.Random(7)
    rows = [(i, ". ".join(_sentences(rng, i))) for i in range(documents)]
    model = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = ["please call 555-234-4567 before noon", "write to jane [at] site [dot] org about it", "see part 555-234-4567 in stock"]
    base, every = pii.spans(model, [*texts, "please call 055-134-4567 before noon"])
    assert base == [[], [], [], []]
    assert every == [[(12, 3, 24)], [(9, 0, 33)], [], []]
    assert all(0 < t <= pii.LIKELY for t in model.thresholds)
    cards = ["charge card 4222.2222.2222.2 now", "charge card 4222222222222 now", "charge card 4111111111111112 now"]
    assert [len(x) for x in pii.spans(model, cards)[1]] == [1, 1, 0]


def test_examples_of_all_documents_are_sampled(spark):
    """Documents with many numbers: those with large ids teach as well."""
    rows = [(i, " ".join(f"call +1 555-234-{k:04} or" for k in range(200))) for i in range(40)]
    got = pii.sampled(spark.createDataFrame(rows, "doc_id long, text string"), 40).collect()
    assert len(got) == 40 * pii.EXAMPLES
    assert {r["doc_id"] for r in got} == set(range(40)) and max(r["start"] for r in got) > 2000


def test_all_documents_teach(spark):
    """Also those that a choice of 20,000 by their hashes leaves out."""
    ids = spark.range(20_400).selectExpr("id AS doc_id").selectExpr("doc_id", "xxhash64(doc_id) AS h").collect()
    last = {r["doc_id"] for r in sorted(ids, key=lambda r: (r["h"], r["doc_id"]))[20_000:]}
    rows = [(i, f"quux +1 555-234-{i % 8999 + 1000} plugh" if i in last else "nothing here") for i in range(20_400)]
    model = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    assert pii.spans(model, ["quux 555-234-4567 plugh"])[1] == [[(5, 3, 17)]]


def test_fit_is_the_same_wherever_examples_lie(spark, monkeypatch):
    """Few distinct examples are fitted in the driver, many in tasks: the sums are equal, however rows are spread."""
    rng = random.Random(7)
    rows = [(i, ". ".join(_sentences(rng, i))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(pii, "TREES", 3)
    here = pii.fit(docs)
    monkeypatch.setattr(pii, "FEW", 0)
    there = pii.fit(docs.repartition(5))
    assert here.thresholds == there.thresholds
    assert here.trees.base == there.trees.base and here.trees.trees == there.trees.trees


def test_words_that_are_pieces_are_remembered_once():
    """A worker holds many words; few of them are only parts of pieces."""
    codec = bpe.Codec(public_tokenizers.path("byte_bpe_50k.json"))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("one two, three", "two three, one; two's one", "one's three two one"):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert " two" in codec.known and not set(codec.words) & set(codec.known)


# --- helpers and registration -------------------------------------------------------------


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    groups = Groups(1200)
    for a, b in edges:
        groups.join(a, b)
    got = {r["node"]: r["root"] for r in frames.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: groups.find(n) for e in edges if e[0] != e[1] for n in e}
    assert frames.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 11))
    assert "pipeline" in entry.queries()
