"""Documents whose sets of five-word shingles are alike: an exact Jaccard join.

A pair can only reach the threshold if it shares shingles among the smallest hashes of both (a prefix). Prefixes that
are a little longer than that share several, so each document may leave out as many of its most frequent ones as the
surplus allows and still meets every partner. The sets of a shingle are ordered by size, and a gap that no link can
cross parts them. What is left tells which documents may have a partner at all; their whole sets are tied to blocks by
their rarest quarter, and within a block a signature tree finds the links.

Equal sets are one entry from the first shuffle on. Only whether documents are connected is kept, never all pairs.
Blocks of more than ``BLOCK`` entries are cut: each part is joined with one pivot, and only entries that are not
connected to the pivot afterwards are compared with the other parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.llm import signature_tree as st
from tablegate.llm.frames import components, few_bytes, few_rows, split_by, stored, with_ids
from tablegate.llm.words import mix, shingles, word_hashes

PERCENT = 75
BLOCK = 512
#: A shingle in more sets than this counts as this frequent; equal counts are ordered by hash.
_OFTEN = 4096
_ROWS = 1 << 17


def surplus(n: int) -> int:
    """Shingles that a prefix is longer than it must be, for a set of n."""
    return n // 10


def surplus_of(n: Column) -> Column:
    return F.floor(n / 10)


def prefix(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 + surplus(n) if n else 0


def digest(tokens: np.ndarray) -> int:
    """Of a set, 63 bits."""
    n = len(tokens)
    both = np.array([int(mix(tokens).sum(dtype=np.uint64)) ^ (n * 0x9E3779B97F4A7C15 & (1 << 64) - 1)], np.uint64)
    return int(mix(both)[0] >> np.uint64(1))


def _sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    return [np.unique(shingles(w)) for w in word_hashes(texts)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows and few bytes; their hashes take about ten times the text."""
    return few_bytes(few_rows(batches), "text", 4 << 20)


def _identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _cut(batches):
        sets = _sets(batch)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([digest(s) for s in sets], pa.int64()), pa.array(map(len, sets), pa.int64())],
            ["doc_id", "d", "n"],
        )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _cut(batches):
        sets = [s for s in _sets(batch) if len(s)]
        most = np.array([len(s) for s in sets], np.int64)
        sizes = np.array([prefix(n) for n in most.tolist()], np.int64)
        names = np.repeat(np.array([digest(s) for s in sets], np.int64), sizes)
        low = np.concatenate([s[:k] for s, k in zip(sets, sizes, strict=True)]) if sets else np.empty(0, np.uint64)
        yield from _rows({"h": low.view(np.int64), "n": np.repeat(most, sizes), "d": names})


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _cut(batches):
        rows = zip(_sets(batch), batch.column("d").to_pylist(), strict=True)
        # Another text of a repeated doc_id has another digest.
        blobs = pa.array([s.tobytes() if digest(s) == d else None for s, d in rows], pa.binary())
        found = pa.Table.from_batches([batch]).drop_columns("text").append_column("tokens", blobs)
        yield from found.filter(pc.is_valid(blobs)).to_batches()


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in few_bytes(batches, "tokens", 4 << 20):
        sets = [np.frombuffer(x, np.int64) for x in batch.column("tokens").to_pylist()]
        sizes = np.array([len(s) for s in sets], np.int64)
        names = np.repeat(np.array(batch.column("d")), sizes)
        tokens = np.concatenate(sets) if sets else np.empty(0, np.int64)
        yield from _rows({"h": tokens, "n": np.repeat(sizes, sizes), "d": names})


def _rows(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    size = len(next(iter(columns.values())))
    for k in range(0, size, _ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[k : k + _ROWS]) for c in columns.values()], list(columns))


class _Runs:
    """Where the sets of a shingle, in order of size, have a gap that no link can cross: rows of one run and its first.

    Sets between two of like sizes are of like sizes too, so all that can link are in one run.
    """

    def __init__(self) -> None:
        self.h, self.n, self.first = 0, 0, None

    def firsts(self, h: np.ndarray, n: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The first set of the run of each row; a run may go on from the rows before."""
        before_h, before_n = np.concatenate(([self.h], h[:-1])), np.concatenate(([self.n], n[:-1]))
        new = (h != before_h) | (100 * before_n < PERCENT * n)
        new[0] |= self.first is None
        first = np.concatenate(([0 if self.first is None else self.first], d[new]))[np.cumsum(new)]
        self.h, self.n, self.first = int(h[-1]), int(n[-1]), int(first[-1])
        return first


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a stream sorted by (h, n, d), the rows whose h is in two sets of like sizes or more.

    Each has the frequency of h and the first set of its run. Rows of a run that is not yet seen to the end are kept.
    """
    empty = np.empty(0, np.int64)
    held_h, held_n, held_d = empty, empty, empty
    hot_h, runs = None, _Runs()

    def out(h: np.ndarray, n: np.ndarray, d: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(h):
            return
        first = runs.firsts(h, n, d)
        at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        count = np.diff(np.append(at, len(h)))
        often = np.repeat(count, count)
        if hot_h is not None:
            often = np.where(h == hot_h, _OFTEN, often)
        # A row alone in its run cannot link by h. The last row stays, as its run may go on.
        keep = (often > 1) & ((first != d) | np.append(first[1:] == d[:-1], True))
        yield from _rows({"d": d[keep], "h": h[keep], "often": np.minimum(often[keep], _OFTEN), "first": first[keep]})

    for batch in batches:
        h = np.concatenate([held_h, np.asarray(batch.column("h"))])
        n = np.concatenate([held_n, np.asarray(batch.column("n"))])
        d = np.concatenate([held_d, np.asarray(batch.column("d"))])
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        h, n, d = h[fresh], n[fresh], d[fresh]
        begin = int(np.searchsorted(h, h[-1])) if len(h) else 0
        if len(h) - begin >= _OFTEN:
            # The last shingle is frequent already: pass its rows on, but for one that tells repeats apart.
            if hot_h != h[-1]:
                yield from out(h[:begin], n[:begin], d[:begin])
                hot_h = int(h[-1])
                h, n, d = h[begin:], n[begin:], d[begin:]
            begin = len(h) - 1
        yield from out(h[:begin], n[:begin], d[:begin])
        held_h, held_n, held_d = h[begin:], n[begin:], d[begin:]
    yield from out(held_h, held_n, held_d)


def _ties(shared: DataFrame, sizes: DataFrame, rare_first: bool) -> DataFrame:
    """Edges (a, b) from the shared shingles that a set must keep to meet every partner of its run.

    ``rare_first``: ``shared`` is of whole sets, so the rarest quarter is a prefix in order of frequency; shingles of
    one set alone come first and count. Else it is of prefixes, and the most frequent ones within the surplus go.
    """
    lists = shared.groupBy("d").agg(F.sort_array(F.collect_list(F.struct("often", "h", "first"))).alias("x"))
    rows = lists.join(sizes, "d")
    least = F.expr(f"(n * {PERCENT} + 99) div 100")
    keep = F.size("x") - (least - 1 if rare_first else surplus_of(least))
    rows = rows.where(keep > 0).select("d", F.explode(F.slice("x", F.lit(1), keep.cast("int"))).alias("y"))
    return rows.select(F.col("d").alias("a"), F.col("y.first").alias("b")).where("a <> b").distinct()


def _sorted_by_shingle(rows: DataFrame) -> DataFrame:
    rows = rows.repartition("h").sortWithinPartitions("h", "n", "d")
    return rows.mapInArrow(_shared_rows, "d long, h long, often long, first long")


def _load(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]


def _links(names: list[int], groups: st.Groups) -> list[tuple[int, int]]:
    return [(names[i], names[r]) for i in range(len(names)) if (r := groups.find(i)) != i and names[i] != names[r]]


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside each part of a block."""
    found: list[tuple[int, int]] = []
    for part in split_by(batches, ["block", "part"]):
        names, sets = part.column("d").to_pylist(), _load(part)
        groups = st.Groups(len(sets))
        top = st.tree(sets, list(range(len(sets))), st.width_for(sets))
        st.connect(sets, top, top, groups, PERCENT)
        found += _links(names, groups)
        if len(found) > _ROWS:
            yield _edges(found)
            found = []
    yield _edges(found)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the entries of a part and a set of entries without a link to the block's pivot."""
    for part in split_by(batches, ["block", "part", "rest"]):
        names, sets, roots = part.column("d").to_pylist(), _load(part), part.column("root").to_pylist()
        groups, first = st.Groups(len(sets)), {}
        for i, root in enumerate(roots):
            groups.join(i, first.setdefault(root, i))
        loose = part.column("loose").to_pylist()
        width = st.width_for(sets)
        sides = [[i for i, x in enumerate(loose) if x is side] for side in (False, True)]
        if all(sides):
            st.connect(sets, *(st.tree(sets, s, width) for s in sides), groups, PERCENT)
        yield _edges(_links(names, groups))


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) to (doc_id, n_shingles, component_id), one row for each row.

    Words are runs of other than ASCII white space, with A-Z lower-cased. A document's set holds its distinct five-word
    shingles; with fewer words, the whole sequence. Documents link when the Jaccard similarity is at least 0.75;
    ``component_id`` is the smallest doc_id reachable by links, itself included. A null or empty text has an empty set
    and links with nothing, as does a row with a null doc_id, whose component is null. Repeated rows and equal texts
    share a component; other columns are not read. An empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    named = stored(docs.mapInArrow(_identify, "doc_id long, d long, n long"))
    sizes = named.where("n > 0 and doc_id is not null").groupBy("d")
    sizes = sizes.agg(F.first("n").alias("n"), F.min("doc_id").alias("doc_id"))
    sizes = stored(sizes)
    low = _sorted_by_shingle(docs.select("text").mapInArrow(_prefixes, "h long, n long, d long"))
    met = _ties(low, sizes.select("d", "n"), False).select(F.explode(F.array("a", "b")).alias("d")).distinct()
    ids = stored(sizes.join(met, "d").select("doc_id", "d"))
    sets = with_ids(docs, ids, "doc_id").select("text", "d")
    sets = stored(sets.mapInArrow(_whole, "d long, tokens binary"))
    again = _sorted_by_shingle(sets.mapInArrow(_explode, "h long, n long, d long"))
    blocks = _sized(components(_ties(again, sizes.select("d", "n"), True)))
    cut = with_ids(sets, stored(blocks.withColumnRenamed("node", "d")), "d").select("d", "block", "size", "tokens")
    parts = F.ceil(F.col("size") / BLOCK)
    cut = stored(cut.withColumn("part", F.pmod(F.xxhash64("d"), parts)))
    links = stored(_link(cut))
    roots = components(links)
    rest = _loose(cut, roots)
    if not rest.isEmpty():
        roots = components(links.union(stored(_compare_rest(cut, roots, rest))))
    return _answer(named, sizes, roots)


def _sized(groups: DataFrame) -> DataFrame:
    """(node, root) to (node, block, size)."""
    groups = stored(groups)
    sizes = stored(groups.groupBy("root").agg(F.count("*").alias("size")))
    return with_ids(groups, sizes, "root").select("node", F.col("root").alias("block"), "size")


def _link(cut: DataFrame) -> DataFrame:
    """Links within parts; each part of a cut block also has the block's pivot, its entry with the smallest digest."""
    pivots = cut.where((F.col("size") > BLOCK) & (F.col("d") == F.col("block")))
    more = pivots.withColumn("other", F.explode(F.sequence(F.lit(0), F.ceil(F.col("size") / BLOCK) - 1)))
    more = more.where("other <> part").select("d", "block", "size", "tokens", F.col("other").alias("part"))
    rows = cut.union(more).select("d", "block", "part", "tokens")
    rows = rows.repartition("block", "part").sortWithinPartitions("block", "part", "d")
    return rows.mapInArrow(_within, "a long, b long").distinct()


def _loose(cut: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries of cut blocks that are not connected to their pivot: (d, block, size, root)."""
    rows = cut.where(F.col("size") > BLOCK).select("d", "block", "size")
    rows = rows.join(roots.withColumnRenamed("node", "d"), "d", "left").withColumn("root", F.coalesce("root", "d"))
    pivots = rows.where("d = block").select("block", F.col("root").alias("main"))
    return rows.join(pivots, "block").where("root <> main").drop("main")


def _compare_rest(cut: DataFrame, roots: DataFrame, rest: DataFrame) -> DataFrame:
    rest = stored(rest)
    groups = rest.groupBy("block").agg(F.ceil(F.count("*") / BLOCK).alias("rests"))
    rows = cut.join(groups, "block").join(roots.withColumnRenamed("node", "d"), "d", "left")
    rows = rows.withColumn("root", F.coalesce("root", "d")).join(rest.select("d", F.lit(True).alias("loose")), "d", "left")
    side = F.explode(F.sequence(F.lit(0), F.col("rests") - 1))
    all_rows = rows.select("d", "block", "part", side.alias("rest"), "tokens", "root", F.lit(False).alias("loose"))
    mine = rows.where("loose").withColumn("rest", F.pmod(F.xxhash64("d", F.lit(1)), "rests"))
    part = F.explode(F.sequence(F.lit(0), F.ceil(F.col("size") / BLOCK) - 1))
    loose = mine.select("d", "block", part.alias("part"), "rest", "tokens", "root", "loose")
    pairs = all_rows.union(loose).repartition("block", "part", "rest")
    return pairs.sortWithinPartitions("block", "part", "rest", "d").mapInArrow(_across, "a long, b long").distinct()


def _answer(named: DataFrame, sizes: DataFrame, roots: DataFrame) -> DataFrame:
    """The smallest doc_id of each group, found over distinct sets; a set of very many documents is one row there."""
    linked = stored(sizes.select("d", "doc_id").join(roots.withColumnRenamed("node", "d"), "d"))
    least = stored(linked.groupBy("root").agg(F.min("doc_id").alias("least")))
    linked = with_ids(linked, least, "root").select("d", "least")
    alone = sizes.select("d", F.col("doc_id").alias("least")).join(linked, "d", "left_anti")
    rows = with_ids(named, stored(linked.union(alone)), "d", "left")
    group = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), group.alias("component_id"))
