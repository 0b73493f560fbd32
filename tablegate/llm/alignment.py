"""Alignment of the tokens of two tokenizers over the same bytes.

Tokens of both kinds tile the bytes of a text. Offsets where tokens of both end cut them into groups, and all pairs of
overlapping tokens lie within a group. A byte range of a text yields a fragment: an open prefix up to its first common
end, closed groups, and an open suffix after its last one. Fragments compose: the suffix of one and the prefix of the
next close a group; a range without a common end is all prefix. Composition is associative, so fragments of very long
documents are made in many tasks and composed by a tree. Closed groups stay where they are closed; only the open ends
of a fragment move up the tree.

Linked pairs are counted in blocks of text. A block keeps its distinct pairs once and sends only those to be summed
over the corpus; what comes back is joined to the block, so no task and no broadcast holds the pairs of the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm import bpe
from tablegate.llm.bpe import Codec
from tablegate.llm.frames import few_bytes, short_batches, split_by, stored
from tablegate.llm.pieces import SPACE, Pieces, pieces

#: Bytes of a range; longer documents are spread over tasks. Fragments composed at a step, bytes of a block of pairs.
RANGE = 1 << 16
FAN = 16
BLOCK = 1 << 21
#: Bytes of whole texts that are aligned together; numpy arrays of 8 bytes for each take several times as much.
_TOGETHER = 1 << 18
#: Words of each of two generations that a worker remembers, and characters of the longest one.
_WORDS, _LONG = 1 << 18, 64

_UNIT = "key long, doc_id long, at long, n_a long, n_b long, n_groups long, n_links long, sha string, size long"
_ENDS = ("head_a", "head_a_ends", "head_b", "head_b_ends", "tail_a", "tail_a_ends", "tail_b", "tail_b_ends")
_MADE = (
    f"block long, units array<struct<{_UNIT.replace(' long', ':long').replace(' string', ':string')}>>, "
    "pair array<int>, times array<int>, pairs array<long>, totals array<long>, "
    "key long, doc_id long, at long, groups string, cut long, " + ", ".join(f"{c} array<long>" for c in _ENDS)
)


@dataclass
class Stream:
    """Tokens of both kinds in order: their ids and the offsets where they end."""

    a: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    a_ends: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    b: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    b_ends: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def between(self, low: int, high: int) -> Stream:
        """Tokens that end in (low, high]."""
        i, j = np.searchsorted(self.a_ends, [low, high], "right")
        k, m = np.searchsorted(self.b_ends, [low, high], "right")
        return Stream(self.a[i:j], self.a_ends[i:j], self.b[k:m], self.b_ends[k:m])

    def __add__(self, other: Stream) -> Stream:
        return Stream(*map(np.concatenate, zip(self.arrays(), other.arrays())))

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_ends, self.b, self.b_ends

    def common(self) -> np.ndarray:
        """Offsets where tokens of both kinds end."""
        return np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)


@dataclass
class Fragment:
    """A byte range: the tokens before its first common end, its last common end (None without any), those after it."""

    head: Stream
    cut: int | None
    tail: Stream


def fragment(tokens: Stream, opens: bool) -> tuple[Fragment, Stream, int]:
    """A fragment of the tokens that end in a byte range, its closed groups, and the offset where those begin.

    ``opens`` says that the tokens are the first of a text, whose beginning is a common end.
    """
    ends = tokens.common()
    if opens:
        ends = np.concatenate(([0], ends))
    if not len(ends):
        return Fragment(tokens, None, Stream()), Stream(), 0
    first, last = int(ends[0]), int(ends[-1])
    far = 1 << 62
    return Fragment(tokens.between(-1, first), last, tokens.between(last, far)), tokens.between(first, last), first


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, Stream | None]:
    """Two neighbouring fragments as one, and the group that this closes, which begins at the cut of ``x``."""
    if x.cut is None:
        return Fragment(x.head + y.head, y.cut, y.tail), None
    if y.cut is None:
        return Fragment(x.head, x.cut, x.tail + y.head), None
    return Fragment(x.head, y.cut, y.tail), x.tail + y.head


def linked(tokens: Stream, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs of ids, links of each token of A) of closed groups that begin at an offset. A pair is A * 2**32 + B."""
    a_begins = np.concatenate(([begin], tokens.a_ends[:-1]))
    b_begins = np.concatenate(([begin], tokens.b_ends[:-1]))
    low = np.searchsorted(tokens.b_ends, a_begins, "right")
    links = np.searchsorted(b_begins, tokens.a_ends, "left") - low
    upto = np.cumsum(links)
    partner = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - links - low, links)
    return (np.repeat(tokens.a, links) << 32) | tokens.b[partner], links


@cache
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below ``n``, where each begins, and how many it has."""
    texts = [str(i).encode() for i in range(n)]
    sizes = np.array([*map(len, texts)], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes


def written(tokens: Stream, ends: np.ndarray, most: int) -> tuple[bytes, np.ndarray]:
    """Groups as text, ``a1,a2|b1;``, each with the semicolon after it, and where each ends in it.

    ``ends`` are the common ends, one for each group; ids are below ``most``.
    """
    a_group, b_group = np.searchsorted(ends, tokens.a_ends), np.searchsorted(ends, tokens.b_ends)
    groups = np.arange(len(ends))
    a_before, b_before = np.searchsorted(a_group, groups), np.searchsorted(b_group, groups)
    a_after, b_after = np.searchsorted(a_group, groups, "right"), np.searchsorted(b_group, groups, "right")
    a_at = np.arange(len(tokens.a)) + b_before[a_group]
    b_at = np.arange(len(tokens.b)) + a_after[b_group]
    ids, marks = np.empty(len(a_at) + len(b_at), np.int64), np.full(len(a_at) + len(b_at), ord(","), np.uint8)
    ids[a_at], ids[b_at] = tokens.a, tokens.b
    marks[a_at[a_after - 1]] = ord("|")
    marks[b_at[b_after - 1]] = ord(";")
    digits, begins, sizes = _decimals(most)
    width = sizes[ids] + 1
    upto = np.cumsum(width)
    # The byte after an id's digits is read too; the mark goes there.
    source = np.repeat(begins[ids] - upto + width, width) + np.arange(upto[-1] if len(upto) else 0)
    out = digits[np.minimum(source, len(digits) - 1)]
    out[upto - 1] = marks
    return out.tobytes(), upto[b_at[b_after - 1]]


class Tokens:
    """Both tokenizers over the bytes of texts, each text with a space before it."""

    def __init__(self, path_a: str, path_b: str):
        self.a: Codec = bpe.Codec(path_a)
        # The strings of special tokens are plain text.
        self.a.stop = None
        self.b: Pieces = pieces(path_b)
        if not self.b.prefix or not self.b.split_at_spaces:
            raise ValueError(f"{path_b} puts no space before a text or has pieces with a space inside")
        self.a_sizes = np.array([*map(len, self.a.texts)], np.int64)
        self.most = max(len(self.a.texts), len(self.b.names))
        #: Ids of words with the space before them: those of A, then those of B moved up by the size of A. Words of now,
        #: and those of before, of which only the ones met again are kept.
        self._words: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def _of_a(self, piece: str) -> bytes | None:
        """Ids of A of a remembered word with the space before it."""
        word = piece[1:] if piece[0] == " " else None
        got = self._words.get(word) or self._before.get(word)
        if got is None:
            return None
        ids, size = memoryview(got).cast("I"), len(self.a.texts)
        return ids[: next(i for i, x in enumerate(ids) if x >= size)].tobytes()

    def _known(self, every: set[str]) -> dict[str, bytes]:
        """The words that are remembered, with all of ``every``."""
        known, before = self._words, self._before
        missing = [w for w in every if w not in known]
        known.update((w, before[w]) for w in missing if w in before)
        new = [w for w in missing if w not in before]
        a, b = [self.a.piece(" " + w, self._of_a) for w in new], self.b.of_words(new)
        moved = (np.frombuffer(b"".join(b), "<u4") + np.uint32(len(self.a.texts))).tobytes()
        ends = np.cumsum([*map(len, b)], dtype=np.int64).tolist()
        known.update((w, x + moved[i:j]) for w, x, i, j in zip(new, a, [0, *ends], ends))
        return known

    def laid_out(self, texts: list[str], sizes: list[int]) -> Stream:
        """Tokens of texts that begin with their space, laid end to end."""
        # No token of either kind reaches across a safe space.
        words: list[str] = []
        for text in texts:
            first, *rest = bpe.split(text)
            # A text's own space is cut off like the others, unless white space follows.
            words += [first[1:], *rest] if first else rest
        every = set(words)
        known = self._known(every)
        both = np.frombuffer(b"".join([known[w] for w in words]), "<u4").astype(np.int64)
        for w in every:
            if len(w) > _LONG:
                del known[w]
        if len(known) > _WORDS:
            self._words, self._before = {}, known
        self.a.forget(_WORDS)
        of_a = both < len(self.a.texts)
        a, b = both[of_a], both[~of_a] - len(self.a.texts)
        found = Stream(a, np.cumsum(self.a_sizes[a]), b, np.cumsum(self.b.sizes[b]))
        total = sum(sizes)
        if total != (found.a_ends[-1] if len(a) else 0) or total != (found.b_ends[-1] if len(b) else 0):
            raise ValueError("tokens do not tile the bytes of their texts")
        return found


def has_tokens(text: str | None) -> bool:
    """Whether the tokens of both kinds join to the text: pieces write a space as U+2581 and cannot tell the two apart."""
    return bool(text) and SPACE not in text


@cache
def _tokens(path_a: str, path_b: str) -> Tokens:
    return Tokens(path_a, path_b)


class _Blocks:
    """Gathers closed groups of documents and gives them out as rows, a block for about ``BLOCK`` bytes."""

    def __init__(self, step: int, size: int, schema: pa.Schema):
        self._number = count()
        self._first = (step << 56) | (TaskContext.get().partitionId() << 32)
        self._size, self._schema = size, schema
        self._clear()

    def _clear(self) -> None:
        self._units, self._codes, self._bytes = [], [], 0

    def add(self, units: list[dict], codes: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
        """Units with their linked pairs, as many for each as its n_links."""
        self._units += units
        self._codes.append(codes)
        self._bytes += size
        if self._bytes >= self._size:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self._units:
            return
        codes = np.concatenate(self._codes)
        # Arrays as long as a block's links go as soon as they are used: every worker holds some of them at once.
        self._codes = []
        pairs, totals = np.unique(codes, return_counts=True)
        own = np.searchsorted(pairs, codes)
        del codes
        # Each unit names its distinct pairs once, with their number.
        own += np.repeat(np.arange(len(self._units)) * max(1, len(pairs)), [u["n_links"] for u in self._units])
        own.sort()
        begins = np.flatnonzero(np.diff(own, prepend=-1))
        own, times = own[begins], np.diff(begins, append=len(own))
        sizes = np.bincount(own // max(1, len(pairs)), minlength=len(self._units))
        for unit, n in zip(self._units, sizes.tolist(), strict=True):
            unit["size"] = n
        one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x.astype(kind)))
        yield self.row(
            block=pa.array([self._first | next(self._number)], pa.int64()),
            units=pa.array([self._units], self._schema.field("units").type),
            pair=one(own % max(1, len(pairs)), np.int32),
            times=one(times, np.int32),
            pairs=one(pairs, np.int64),
            totals=one(totals, np.int64),
        )
        self._clear()

    def row(self, **columns: pa.Array) -> pa.RecordBatch:
        rows = len(next(iter(columns.values())))
        arrays = [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(rows, f.type) for f in self._schema]
        return pa.RecordBatch.from_arrays(arrays, schema=self._schema)

    def part(self, key: int, doc_id: int | None, closed: Stream, begin: int, most: int) -> Iterator[pa.RecordBatch]:
        """Closed groups of a document that has more: their counts go to the block, their text into a row."""
        if not len(closed.a):
            return
        ends = closed.common()
        text, _ = written(closed, ends, most)
        pairs, _ = linked(closed, begin)
        unit = _unit(key, doc_id, begin, len(closed.a), len(closed.b), len(ends), len(pairs), None)
        yield self.row(key=pa.array([key], pa.int64()), at=pa.array([begin], pa.int64()), groups=pa.array([text[:-1].decode()]))
        yield from self.add([unit], pairs, int(closed.a_ends[-1]) - begin)

    def open(self, key: int, doc_id: int | None, at: int, f: Fragment) -> pa.RecordBatch:
        ends = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (*f.head.arrays(), *f.tail.arrays())]
        named = {n: pa.array([v], pa.int64()) for n, v in (("key", key), ("doc_id", doc_id), ("at", at), ("cut", f.cut))}
        return self.row(**named, **dict(zip(_ENDS, ends, strict=True)))


def _unit(key, doc_id, at, n_a, n_b, n_groups, n_links, sha) -> dict:
    found = {"key": key, "doc_id": doc_id, "at": at, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links}
    return {**found, "sha": sha, "size": 0}


def _schema(spark) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(_MADE))


def _whole(tokens: Tokens, batch: pa.RecordBatch) -> tuple[list[dict], np.ndarray, int]:
    """Units of whole documents, aligned together: the end of each is a common end. With linked pairs and bytes."""
    ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
    texts = [" " + t if has_tokens(t) else "" for t in batch.column("text").to_pylist()]
    sizes = [len(t.encode()) for t in texts]
    stream = tokens.laid_out(texts, sizes)
    pairs, links = linked(stream, 0)
    ends = stream.common()
    text, text_ends = written(stream, ends, tokens.most)
    upto = np.cumsum(sizes)
    a_upto, b_upto = np.searchsorted(stream.a_ends, upto, "right"), np.searchsorted(stream.b_ends, upto, "right")
    groups = np.searchsorted(ends, upto, "right")
    link_upto = np.concatenate(([0], np.cumsum(links)))[a_upto]
    text_upto = np.concatenate(([0], text_ends))[groups].tolist()
    counts = np.stack([np.diff(x, prepend=0) for x in (a_upto, b_upto, groups, link_upto)], 1).tolist()
    units, begin = [], 0
    for key, doc_id, n, upto_text in zip(keys, ids, counts, text_upto, strict=True):
        sha = hashlib.sha256(text[begin : upto_text - 1]).hexdigest() if n[0] else ""
        units.append(_unit(key, doc_id, None, *n, sha))
        begin = upto_text
    return units, pairs, sum(sizes) + 64 * len(sizes)


def _whole_blocks(paths: tuple[str, str], schema: pa.Schema, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, blocks = _tokens(*paths), _Blocks(0, size, schema)
        for batch in few_bytes(batches, "text", _TOGETHER):
            yield from blocks.add(*_whole(tokens, batch))
        yield from blocks.flush()

    return run


def _cuts(width: int):
    """Pieces of texts, cut before spaces where tokens of both kinds end: (key, doc_id, begin, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "text")), strict=True):
                text, at, begin = " " + text, 0, 0
                while at < len(text):
                    upto = text.find(" ", at + width)
                    # A space after white space of any kind may belong to what is before it.
                    while upto > 0 and text[upto - 1].isspace():
                        upto = text.find(" ", upto + 1)
                    piece = text[at : upto if upto > 0 else len(text)]
                    yield pa.RecordBatch.from_pydict(
                        {"key": [key], "doc_id": pa.array([doc_id], pa.int64()), "begin": [begin], "text": [piece]}
                    )
                    at, begin = at + len(piece), begin + len(piece.encode())

    return run


def _fragments(paths: tuple[str, str], schema: pa.Schema, size: int, width: int):
    """The fragment of each byte range of a piece, with the groups that are closed in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, blocks = _tokens(*paths), _Blocks(1, size, schema)
        for batch in few_bytes(batches, "text"):
            for key, doc_id, begin, text in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "begin", "text")), strict=True):
                n = len(text.encode())
                stream = tokens.laid_out([text], [n])
                stream = Stream(stream.a, stream.a_ends + begin, stream.b, stream.b_ends + begin)
                for low in range(begin // width * width, begin + n, width):
                    at = max(low, begin)
                    found, closed, first = fragment(stream.between(at, low + width), at == 0)
                    yield from blocks.part(key, doc_id, closed, first, tokens.most)
                    yield blocks.open(key, doc_id, at, found)
        yield from blocks.flush()

    return run


def _composed(paths: tuple[str, str], schema: pa.Schema, size: int, step: int):
    """Neighbouring fragments of a sorted stream composed, with the groups that this closes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most, blocks = _tokens(*paths).most, _Blocks(step, size, schema)
        for table in split_by(batches, ["key", "node"]):
            whole, first = None, None
            for row in table.to_pylist():
                ends = [np.array(row[c], np.int64) for c in _ENDS]
                this = Fragment(Stream(*ends[:4]), row["cut"], Stream(*ends[4:]))
                if whole is None:
                    whole, first = this, row
                    continue
                begin = whole.cut
                whole, closed = compose(whole, this)
                if closed is not None:
                    yield from blocks.part(row["key"], row["doc_id"], closed, begin, most)
            yield blocks.open(first["key"], first["doc_id"], first["at"], whole)
        yield from blocks.flush()

    return run


def _made(docs: DataFrame, paths: tuple[str, str], width: int, fan: int, size: int) -> list[DataFrame]:
    """Stored blocks and parts of whole documents, of the fragments of long ones, and of each step of their tree."""
    schema = _schema(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long"), "text")
    is_long = F.coalesce((F.octet_length("text") > width) & ~F.contains("text", F.lit(SPACE)), F.lit(False))
    made = [stored(rows.where(~is_long).mapInArrow(_whole_blocks(paths, schema, size), _MADE))]
    pieces_of = rows.where(is_long).mapInArrow(_cuts(width), "key long, doc_id long, begin long, text string")
    spread = pieces_of.repartition("key", "begin")
    made.append(stored(spread.mapInArrow(_fragments(paths, schema, size, width), _MADE)))
    span, step = width, 2
    while (last := made[-1].where("head_a IS NOT NULL").agg(F.max("at")).first()[0]) is not None and last >= span:
        span *= fan
        opened = made[-1].where("head_a IS NOT NULL").select("key", "doc_id", "at", "cut", *_ENDS)
        nodes = opened.withColumn("node", F.floor(F.col("at") / span)).repartition("key", "node")
        nodes = nodes.sortWithinPartitions("key", "node", "at")
        made.append(stored(nodes.mapInArrow(_composed(paths, schema, size, step), _MADE)))
        step += 1
    return made


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the links of each unit of a block, from the corpus counts of the block's pairs."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            units = row.column("units").to_pylist()[0]
            flat = lambda c: row.column(c).flatten()
            pair, times = flat("pair").to_numpy(), flat("times").to_numpy().astype(np.int64)
            found = flat("counts")
            values = np.zeros(len(found), np.int64)
            if len(found):
                at, n = found.flatten()
                values[at.to_numpy()] = n.to_numpy()
            values = values[pair]
            upto = np.cumsum([0, *(u["size"] for u in units)])
            sums = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[upto])
            best, total = sums(times * (values & 1)), sums(times * (values >> 1))
            names = ("key", "doc_id", "at", "n_a", "n_b", "n_groups", "n_links")
            columns = [pa.array([u[n] for u in units], pa.int64()) for n in names]
            columns += [pa.array(best), pa.array(total), pa.array([u["sha"] for u in units], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_best", "count_sum", "sha"])


def _joined_sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of the parts of each document in a sorted stream, which are read one after the other."""
    key, sha = None, None
    for batch in batches:
        for k, text in zip(batch.column("key").to_pylist(), batch.column("groups").to_pylist(), strict=True):
            if k != key:
                if sha is not None:
                    yield pa.RecordBatch.from_pydict({"key": [key], "joined": [sha.hexdigest()]})
                key, sha = k, hashlib.sha256(text.encode())
            else:
                sha.update(b";" + text.encode())
    if sha is not None:
        yield pa.RecordBatch.from_pydict({"key": [key], "joined": [sha.hexdigest()]})


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best) of every linked pair of the corpus: how many links hold it, and if no pair of its B id has more."""
    rows = blocks.select(F.explode(F.arrays_zip("pairs", "totals")).alias("p")).select("p.pairs", "p.totals")
    counts = rows.groupBy(F.col("pairs").alias("pair")).agg(F.sum("totals").alias("n"))
    # One row for each id of B, which the vocabulary bounds.
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, path_a: str, path_b: str, width: int = RANGE, fan: int = FAN, block: int = BLOCK) -> DataFrame:
    """Tokens of each text by the byte-level vocabulary A and the pieces B, aligned by bytes; a row for each row.

    Columns: doc_id, n_a, n_b tokens, n_groups between common ends, n_links of overlapping tokens, n_best of them
    whose pair of ids is the most frequent of its B id in the corpus (ties included), count_sum of the corpus counts of
    their pairs, groups_sha256 of ``a1,a2|b1;a3|b2,b3``. Null and empty texts, and those that hold U+2581, have no
    tokens: zeros and an empty hash. Null and repeated doc_ids pass through, other columns are not read.
    """
    short_batches(docs.sparkSession)
    made = _made(docs, (path_a, path_b), width, fan, block)
    every = made[0]
    for df in made[1:]:
        every = every.union(df)
    blocks = every.where("block IS NOT NULL")
    counts = stored(pair_counts(blocks))
    wanted = blocks.select("block", F.posexplode(F.col("pairs")).alias("i", "pair"))
    found = wanted.join(counts, "pair").select("block", "i", (2 * F.col("n") + F.col("best").cast("long")).alias("n"))
    found = found.groupBy("block").agg(F.collect_list(F.struct("i", "n")).alias("counts"))
    scored = blocks.select("block", "units", "pair", "times").join(found, "block", "left").drop("block")
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = "key long, doc_id long, at long, " + ", ".join(f"{n} long" for n in names) + ", sha string"
    units = stored(scored.mapInArrow(_scores, schema))
    out = units.where("at IS NULL").select("doc_id", *names, F.col("sha").alias("groups_sha256"))
    parts = every.where("groups IS NOT NULL").select("key", "at", "groups")
    texts = parts.repartition("key").sortWithinPartitions("key", "at").mapInArrow(_joined_sha, "key long, joined string")
    sums = units.where("at IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc_id"), *[F.sum(n).alias(n) for n in names])
    return out.union(sums.join(texts, "key").select("doc_id", *names, "joined"))
