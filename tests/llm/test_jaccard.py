"""The Jaccard join against brute force."""

from __future__ import annotations

import random
import re

import pytest

from tablegate.llm import jaccard
from tablegate.llm import signature_tree as st
from tablegate.llm.words import shingles, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    sets = {}
    for i, (doc, text) in enumerate(rows):
        w = WORD.findall((text or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    groups = st.Groups(len(rows))
    for i in sets:
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= 75 * len(a | b):
                groups.join(i, j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = groups.find(i)
            least[r] = min(least.get(r, doc), doc)
    return sorted(
        ((d, len(sets[i]), None if d is None else least[groups.find(i)]) for i, (d, _) in enumerate(rows)), key=str
    )


def made(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = [rng.choice(words) for _ in range(60)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.5 and texts:
            w = (rng.choice(texts) or "").split(" ")
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(words).upper()
            w += [rng.choice(words) for _ in range(rng.choice((0, 0, 3, 20)))]
        else:
            w = [rng.choice(words) for _ in range(rng.choice((0, 1, 3, 5, 8, 40, 120)))]
            if kind > 0.8:
                w += common
        texts.append(" ".join(w))
    texts += [None, "", "  \n\t", "One two", "one  TWO\n", "one two three"]
    return texts


@pytest.mark.parametrize(("seed", "block"), [(1, 512), (2, 8)])
def test_groups_equal_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = [(i * 3, t) for i, t in enumerate(made(seed, 150))] + [(0, "w1 w2"), (None, "one two"), (6, "x " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS d", "2 AS n")
    got = sorted(map(tuple, jaccard.jaccard_groups(df).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark):
    assert jaccard.jaccard_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_hashes_follow_the_words():
    texts = ["Ab c\td", "aB C d", "ab cd", None, "", "é " * 7, "x" * 3_000_000 + " y", "a b " * 600_000]
    got = word_hashes([t if t is None else t.encode() for t in texts])
    assert [len(x) for x in got] == [3, 3, 2, 0, 0, 7, 2, 1_200_000]
    assert (got[0] == got[1]).all() and got[0][1] != got[2][1]
    assert len(set(got[7].tolist())) == 2 and len(set(shingles(got[7]).tolist())) == 2


def test_frequent_shingles_are_streamed():
    import numpy as np
    import pyarrow as pa

    h = np.repeat([1, 2, 3, 4], [2, 9000, 1, 5000])
    d = np.concatenate([np.arange(k) for k in (2, 9000, 1, 5000)])
    table = pa.table({"h": h, "n": np.full(len(h), 7), "d": d})
    out = pa.Table.from_batches(jaccard._shared_rows(iter(table.to_batches(1000))))
    got = out.to_pydict()
    assert sorted(zip(got["h"], got["d"])) == [(x, y) for x, y in zip(h.tolist(), d.tolist()) if x != 3]
    assert set(zip(got["h"], got["often"], got["first"])) == {(1, 2, 0), (2, 4096, 0), (4, 4096, 0)}


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_sizes_part_the_sets_of_a_shingle(size):
    import numpy as np
    import pyarrow as pa

    rows = [(1, 10, 5), (1, 13, 6), (1, 17, 7), (1, 23, 8), (2, 23, 8), (2, 30, 9), (2, 31, 1), (2, 50, 2), (3, 50, 2), (3, 50, 4)]
    table = pa.table(dict(zip(("h", "n", "d"), np.array(rows).T)))
    out = pa.Table.from_batches(jaccard._shared_rows(iter(table.to_batches(size)))).to_pydict()
    first = {(h, d): f for h, d, f in zip(out["h"], out["d"], out["first"])}
    # 17 to 23 is a gap, 23 to 30 is none; rows that end a batch may stay without a partner.
    assert [first.get(k) for k in ((1, 5), (1, 6), (1, 7))] == [5, 5, 5]
    assert [first.get(k) for k in ((2, 8), (2, 9), (2, 1))] == [8, 8, 8]
    assert [first.get(k) for k in ((3, 2), (3, 4))] == [2, 2]
    assert first.get((1, 8), 8) == 8 and first.get((2, 2), 2) == 2


def test_dense_sizes_and_gaps_equal_brute_force(spark):
    """Documents around one passage whose sizes lie close together, with their neighbours just within or out of reach."""
    passage = [f"p{i}" for i in range(40)]
    texts = [" ".join(passage + [f"x{k}y{i}" for i in range(k)]) for k in range(0, 60, 2)]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.jaccard_groups(df).collect()), key=str) == brute(rows)
