"""Repeated passages by content-defined chunking.

A gear hash rolls over the bytes of a text: it is shifted by one bit for each byte and a byte's random number is
added, so its top bits depend on the last 16 bytes at most. A chunk ends where its top bits are all zero. Where chunks end
therefore depends only on what is near, and an insertion changes no chunk but the ones it touches. Windows are the
shortest runs of neighbouring chunks with enough words; windows with the same digest are the same, and what is covered
by windows that also stand elsewhere is a repeated passage. One of them stays, the others can be dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.frames import few_rows
from tablegate.llm.words import _tables

#: A chunk may end at one byte in 2**BITS; the hash covers WINDOW bytes.
BITS = 4
WINDOW = 16
#: An end this close to the one before is none.
LEAST = 8
#: Words that start inside a run of chunks and make it a passage; a run lies inside the passage, so this is less than its words.
PASSAGE_WORDS = 20
_BLOCK = 1 << 21


@cache
def gear() -> np.ndarray:
    """A random number for each byte; none for NUL, which stands between texts."""
    out = np.random.default_rng(2016).integers(1, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
    out[0] = 0
    return out


def rolled(data: np.ndarray) -> np.ndarray:
    """The gear hash at each byte, in five steps that double the window each."""
    h = gear()[data]
    reach = 1
    while reach < WINDOW:
        h[reach:] = h[reach:] + (h[:-reach] << np.uint32(reach))
        reach *= 2
    return h


def ends(texts: list[bytes]) -> list[np.ndarray]:
    """Where the chunks of each text end."""
    out: list[np.ndarray] = []
    todo, size = [], 0

    def flush() -> None:
        data = np.frombuffer(b"".join(t + bytes(WINDOW) for t in todo), np.uint8)
        cut = np.flatnonzero(rolled(data) >> np.uint32(32 - BITS) == 0) + 1
        begin = np.cumsum([0, *(len(t) + WINDOW for t in todo)])
        at = np.searchsorted(cut, begin, "right")
        for k, t in enumerate(todo):
            out.append(_merged(cut[at[k] : at[k + 1]] - begin[k], len(t)))
        todo.clear()

    for t in texts:
        if todo and size + len(t) > _BLOCK:
            flush()
            size = 0
        todo.append(t)
        size += len(t) + WINDOW
    if todo:
        flush()
    return out


def _merged(cuts: np.ndarray, size: int) -> np.ndarray:
    """Ends without those that follow another end or the start closely; a text's own end is one."""
    cuts = cuts[cuts < size]
    far = np.diff(cuts, prepend=0) >= LEAST
    return np.append(cuts[far], size) if size else cuts[:0]


def windows(text: bytes, stops: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Begin, stop, words before and words of each run of chunks with ``least`` words that has no shorter one.

    For each chunk the shortest run that begins with it and the shortest that ends with it. A word is counted where it
    starts after a run's first byte, so equal bytes have equal windows whatever stands before them.
    """
    blank = _tables()[1][np.frombuffer(text, np.uint8)]
    starts = np.zeros(len(text) + 1, np.int32)
    np.cumsum(~blank & np.concatenate(([True], blank[:-1])), out=starts[1:])
    begins = np.concatenate(([0], stops[:-1])).astype(int)
    before, upto = starts[begins + 1], starts[stops]
    n = len(stops)
    ahead = np.searchsorted(upto, before + least)
    back = np.searchsorted(before, upto - least, "right") - 1
    pairs = np.concatenate([np.arange(n)[ahead < n] * n + ahead[ahead < n], back[back >= 0] * n + np.arange(n)[back >= 0]])
    first, last = np.divmod(np.unique(pairs), n)
    return begins[first], stops[last], before[first], upto[last] - before[first]


def _windows(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            ids = batch.column("doc_id").to_pylist()
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            docs, digests, places = [], [], []
            for doc, text, stops in zip(ids, texts, ends(texts), strict=True):
                if not text:
                    continue
                found = windows(text, stops, least)
                spans = zip(found[0].tolist(), found[1].tolist(), strict=True)
                digests += [hashlib.blake2b(text[b:e], digest_size=8).digest() for b, e in spans]
                places.append(np.stack(found).astype(np.int32))
                docs.append(np.full(len(found[0]), doc, np.int64))
            if not docs:
                continue
            columns = [pa.array(c) for c in np.concatenate(places, 1)]
            columns = [pa.array(np.frombuffer(b"".join(digests), np.int64)), pa.array(np.concatenate(docs)), *columns]
            whole = pa.RecordBatch.from_arrays(columns, ["digest", "doc_id", "begin", "stop", "before", "words"])
            for k in range(0, whole.num_rows, 1 << 16):
                yield whole.slice(k, 1 << 16)

    return run


_WINDOW = "digest long, doc_id long, begin int, stop int, before int, words int"


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by all their columns without those equal to the row before."""
    last: list | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(c) for c in batch.columns]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is None or last != [c[0] for c in columns]
        last = [c[-1] for c in columns]
        yield batch if new.all() else batch.filter(pa.array(new))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of windows sorted by (digest, doc_id, begin), those at two places or more, with the first document of these.

    ``extra`` tells whether a window stands elsewhere before: in a smaller doc_id, or earlier in its own document.
    """
    held: pa.RecordBatch | None = None
    open_run: tuple[int, int, int] | None = None  # a digest that was found shared, and its first place

    def out(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        digest, doc, begin = (np.asarray(rows.column(c)) for c in ("digest", "doc_id", "begin"))
        new = np.ones(len(digest), bool)
        new[1:] = digest[1:] != digest[:-1]
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(digest)))
        first, place = np.repeat(doc[at], size), np.repeat(begin[at], size)
        last = np.repeat(at + size - 1, size)
        keep = (first != doc[last]) | (place != begin[last])
        if open_run is not None:
            mine = digest == open_run[0]
            first, place = np.where(mine, open_run[1], first), np.where(mine, open_run[2], place)
            keep |= mine
        extra = (doc != first) | (begin != place)
        found = rows.append_column("first_doc_id", pa.array(first)).append_column("extra", pa.array(extra))
        yield from found.filter(pa.array(keep)).combine_chunks().to_batches()

    for batch in batches:
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        if not rows.num_rows:
            continue
        digest, doc = np.asarray(rows.column("digest")), np.asarray(rows.column("doc_id"))
        place = np.asarray(rows.column("begin"))
        begin = len(digest) - int(np.searchsorted(digest[::-1] != digest[-1], True)) if (digest != digest[-1]).any() else 0
        shared = open_run is not None and open_run[0] == digest[-1]
        if shared or (doc[begin], place[begin]) != (doc[-1], place[-1]):
            yield from out(rows)
            if not shared:
                open_run = (int(digest[-1]), int(doc[begin]), int(place[begin]))
            held = None
        else:
            yield from out(rows.slice(0, begin))
            held = (rows.slice(begin).combine_chunks().to_batches() or [None])[0]
    if held is not None:
        yield from out(pa.Table.from_batches([held]))


def shared_windows(docs: DataFrame, least_words: int = PASSAGE_WORDS) -> DataFrame:
    """Windows of (doc_id, text) that stand at another place too, each with ``extra``: the decision to drop it.

    Of equal windows the first by doc_id and place stays. Whatever is dropped still stands at an earlier place. Windows
    of equal rows are given once; only where other texts of the same doc_id have another window at the same place can
    there be equal ones.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    rows = rows.mapInArrow(_windows(least_words), _WINDOW)
    rows = rows.repartition("digest").sortWithinPartitions("digest", "doc_id", "begin", "stop", "before", "words")
    return rows.mapInArrow(lambda b: _shared(_once(b)), f"{_WINDOW}, first_doc_id long, extra boolean").drop("digest")


def _opens(which: str) -> Column:
    """1 for a window that touches none before it in its document, among those where ``which`` holds, else 0."""
    line = Window.partitionBy("doc_id").orderBy("begin", "stop")
    last = F.max(F.when(F.expr(which), F.col("stop"))).over(line.rowsBetween(Window.unboundedPreceding, -1))
    return F.when(F.expr(which), F.coalesce((last < F.col("begin")).cast("int"), F.lit(1)))


def _runs(docs: DataFrame, least_words: int) -> DataFrame:
    """Runs of shared windows, in parts: one for each stretch that is dropped, and one for what is not."""
    rows = shared_windows(docs, least_words)
    line = Window.partitionBy("doc_id").orderBy("begin", "stop")
    rows = rows.withColumn("gap", _opens("true")).withColumn("cut", _opens("extra"))
    rows = rows.withColumn("run", F.sum("gap").over(line)).withColumn("part", F.when(F.col("extra"), F.sum("cut").over(line)))
    return rows.groupBy("doc_id", "run", "part").agg(
        F.min("begin").alias("begin"),
        F.max("stop").alias("stop"),
        F.min("before").alias("before"),
        F.max(F.col("before") + F.col("words")).alias("upto"),
        F.min("first_doc_id").alias("first_doc_id"),
    )


def repeated_passages(docs: DataFrame, least_words: int = PASSAGE_WORDS) -> DataFrame:
    """Passages of (doc_id, text) that stand elsewhere too: (doc_id, begin, stop, n_words, first_doc_id, drops).

    Every byte of a passage lies in a window of chunks with ``least_words`` words or more that also stands in another
    document or at another place of this one. A row for each run of such windows: its place in bytes of UTF-8, its
    words, the smallest doc_id that holds one of its windows, and ``drops``, the spans of it that stand at an earlier
    place (see ``spans_to_drop``) as begin:stop with commas. The run lies inside the passage and misses at most what lies
    before its first and after its last chunk end. A document without such a run has no row, nor has one with a null
    doc_id or text. Repeated rows of one doc_id are one document. Other columns are not read. Ties do not arise.
    """
    drop = F.when(F.col("part").isNotNull(), F.struct("begin", "stop"))
    found = _runs(docs, least_words).groupBy("doc_id", "run").agg(
        F.min("begin").alias("begin"),
        F.max("stop").alias("stop"),
        (F.max("upto") - F.min("before")).alias("n_words"),
        F.min("first_doc_id").alias("first_doc_id"),
        F.array_sort(F.collect_list(drop)).alias("spans"),
    )
    written = F.transform("spans", lambda x: F.concat_ws(":", x["begin"].cast("string"), x["stop"].cast("string")))
    return found.withColumn("drops", F.array_join(written, ",")).select(
        "doc_id", "begin", "stop", "n_words", "first_doc_id", "drops"
    )


def spans_to_drop(docs: DataFrame, least_words: int = PASSAGE_WORDS) -> DataFrame:
    """Spans (doc_id, begin, stop) in bytes that also stand at an earlier place, in a smaller doc_id or before them."""
    return _runs(docs, least_words).where("part is not null").select("doc_id", "begin", "stop")


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without sorted spans, which are narrowed to whole characters."""
    out, at = [], 0
    for begin, stop in spans:
        while begin < stop and text[begin] & 0xC0 == 0x80:
            begin += 1
        while begin < stop < len(text) and text[stop] & 0xC0 == 0x80:
            stop -= 1
        out.append(text[at:begin])
        at = max(at, stop)
    return b"".join([*out, text[at:]])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in few_rows(batches):
        spans = [[(s["begin"], s["stop"]) for s in x or []] for x in batch.column("_drops").to_pylist()]
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        new = [t if t is None else without(t, x).decode() for t, x in zip(texts, spans, strict=True)]
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(new, pa.string())).drop_columns(["_drops"])


def without_repeats(docs: DataFrame, least_words: int = PASSAGE_WORDS) -> DataFrame:
    """``docs`` without the spans to drop. A null text or doc_id passes through, as do other columns and the rows of a
    doc_id that has several texts, whose places cannot be told apart.
    """
    drops = spans_to_drop(docs, least_words).groupBy(F.col("doc_id").alias("_doc"))
    drops = drops.agg(F.array_sort(F.collect_list(F.struct("begin", "stop"))).alias("_drops"))
    text = F.xxhash64("text")
    several = docs.groupBy(F.col("doc_id").cast("long").alias("_doc")).agg((F.min(text) < F.max(text)).alias("several"))
    drops = drops.join(several.where("several"), "_doc", "left_anti")
    rows = docs.join(drops, F.col("doc_id").cast("long") == F.col("_doc"), "left").select(*docs.columns, "_drops")
    return rows.mapInArrow(_cut, docs.schema)
