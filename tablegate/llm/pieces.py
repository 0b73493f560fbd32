"""SentencePiece encoding and decoding with a merge-type vocabulary.

Symbols start as the characters of the text. An agenda holds the adjacent pairs whose joined text is a piece, the
highest score first and of equal scores the leftmost; the head is merged and its new neighbours join the agenda,
until it is empty. What is no piece in the end is written as byte pieces. Where no piece of the vocabulary spans two
characters, the text falls apart into parts with agendas of their own. Long parts use a heap, whose entries are passed
over if their symbols have changed since. The short parts of an Arrow batch are merged together: each round takes the
head of every agenda. Words recur, so a worker remembers their ids. The decoder copies byte ranges that an offset
table names. Ids can be checked against the sentencepiece library, Arrow batch by Arrow batch.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.llm.frames import few_bytes

SPACE = "▁"
# Kinds of pieces and of models in a model file, and how an unknown piece is written.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_MERGES = 2
_UNKNOWN_TEXT = " ⁇ "
_NO_RANK = 1 << 40
#: Words whose ids are kept in a worker, and characters of the longest one.
_CACHE, _CACHE_WORD = 1 << 19, 64
#: Characters up to which parts are merged together.
_SHORT = 64


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("each-byte", _each_byte)


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol-buffer message; fixed-width values stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(raw):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}[wire] if wire != 2 else varint()
        yield tag >> 3, raw[at : at + size]
        at += size


class Pieces:
    """The vocabulary of a model file: merges by score, byte fallback, spaces written as U+2581, no other rewriting."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(_fields(f.read()))
        training = dict(x for number, value in model if number == 2 for x in _fields(value))
        rewriting = dict(x for number, value in model if number == 3 for x in _fields(value))
        plain = not rewriting.get(2) and not rewriting.get(4, 1) and rewriting.get(5, 1) and not training.get(24, 0)
        entries = [dict(_fields(value)) for number, value in model if number == 1]
        kinds = [e.get(3, _NORMAL) for e in entries]
        if training.get(3, 1) != _MERGES or not training.get(35, 0) or not plain:
            raise ValueError(f"{path} is no vocabulary of merges with byte fallback and plain text")
        if not set(kinds) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or kinds.count(_BYTE) != 256:
            raise ValueError(f"{path} has unused or user-defined pieces, or no piece for some byte")
        #: Whether a space is put before every text.
        self.prefix = bool(rewriting.get(3, 1))
        texts = [e[1].decode() for e in entries]
        scores = [struct.unpack("<f", e[2])[0] if 2 in e else 0.0 for e in entries]
        self.ids = {t: i for i, (t, kind) in enumerate(zip(texts, kinds, strict=True)) if kind == _NORMAL}
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in self.ids.values()}, reverse=True))}
        self.rank = {t: order[scores[i]] for t, i in self.ids.items()}
        self.byte_ids = [0] * 256
        #: The bytes each id stands for when tokens are laid over a text.
        self.bytes_of: list[bytes] = []
        for i, (text, kind) in enumerate(zip(texts, kinds, strict=True)):
            if kind == _BYTE:
                self.byte_ids[int(text[3:5], 16)] = i
                self.bytes_of.append(bytes([int(text[3:5], 16)]))
            else:
                raw = {_NORMAL: text.replace(SPACE, " "), _UNKNOWN: _UNKNOWN_TEXT}.get(kind, "")
                self.bytes_of.append(raw.encode())
        self.names = [str(i) for i in range(len(texts))]
        self.sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self._offsets = np.concatenate(([0], np.cumsum(self.sizes)))
        self._bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        #: Pieces that start with a space which is not the one before the text.
        self._unstripped = {self.byte_ids[32], *(i for i, kind in enumerate(kinds) if kind == _UNKNOWN)}
        self._parts = self._boundaries()
        # Pairs of pieces whose joined text is a piece, in order of their codes, and that piece.
        pairs = {(self.ids[t[:k]] << 32) | self.ids[t[k:]]: i for t, i in self.ids.items() for k in range(1, len(t)) if t[:k] in self.ids and t[k:] in self.ids}
        self._pairs = np.array(sorted(pairs), np.int64)
        self._joined = np.array([pairs[p] for p in self._pairs.tolist()], np.int64)
        self._ranks = np.full(len(texts) + 1, _NO_RANK, np.int64)
        self._ranks[[*self.ids.values()]] = [self.rank[t] for t in self.ids]
        self._letters = np.array(sorted(ord(t) for t in self.ids if len(t) == 1), np.int64)
        self._letter_ids = np.array([self.ids[chr(c)] for c in self._letters.tolist()], np.int64)
        #: Ids of words with the space before them, and of parts that are no words.
        self._words: dict[str, bytes] = {}
        self._others: dict[str, bytes] = {}

    def _boundaries(self) -> re.Pattern:
        """Parts that no piece reaches across: spaces with what follows, if pieces have spaces only in front."""
        long = [t for t in self.ids if len(t) > 1]
        if any(SPACE in t.lstrip(SPACE) for t in long):
            self.split_at_spaces = False
            return re.compile("(?s).+")
        self.split_at_spaces = True
        inner = "".join(sorted({c for t in long for c in t} - {SPACE}))
        inside = f"[{re.escape(inner)}]" if inner else "(?!)"
        return re.compile(f"(?s){SPACE}*{inside}+|{SPACE}+|.")

    def _spelled(self, letter: str) -> list[int]:
        """Ids of a character that is no piece."""
        return [self.byte_ids[b] for b in letter.encode()]

    def merge(self, text: str) -> list[int]:
        """Ids of one part, merged by an agenda in a heap."""
        ids, rank, size = self.ids, self.rank, len(text)
        ends, after = list(range(1, size + 1)), list(range(1, size + 1))
        before, alive = list(range(-1, size - 1)), bytearray(b"\x01") * size
        agenda = [(r << 40) | i for i in range(size - 1) if (r := rank.get(text[i : i + 2])) is not None]
        heapify(agenda)
        while agenda:
            head = heappop(agenda)
            left = head & 0xFFFFFFFFFF
            right = after[left]
            if not alive[left] or right == size or rank.get(text[left : ends[right]]) != head >> 40:
                continue
            ends[left], after[left], alive[right] = ends[right], after[right], 0
            if (follows := after[left]) < size:
                before[follows] = left
                if (r := rank.get(text[left : ends[follows]])) is not None:
                    heappush(agenda, (r << 40) | left)
            if (leads := before[left]) >= 0 and (r := rank.get(text[leads : ends[left]])) is not None:
                heappush(agenda, (r << 40) | leads)
        out: list[int] = []
        at = 0
        while at < size:
            i = ids.get(text[at : ends[at]])
            out += self._spelled(text[at]) if i is None else [i]
            at = after[at]
        return out

    def _join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, -1 for none. Symbols that are no piece are below zero."""
        codes = (left << 32) | right
        at = np.minimum(np.searchsorted(self._pairs, codes), len(self._pairs) - 1)
        return np.where((self._pairs[at] == codes) & (left >= 0) & (right >= 0), self._joined[at], -1)

    def merge_together(self, parts: list[str]) -> list[bytes]:
        """Ids of many parts that are not empty. Each round merges the head of every agenda that is not empty."""
        letters = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self._letters, letters), len(self._letters) - 1)
        symbols = np.where(self._letters[at] == letters, self._letter_ids[at], -1 - letters)
        sizes = np.array([*map(len, parts)], np.int64)
        part = np.repeat(np.arange(len(parts)), sizes)
        joined = np.full(len(symbols), -1, np.int64)
        inner = np.flatnonzero(part[:-1] == part[1:])
        joined[inner] = self._join(symbols[inner], symbols[inner + 1])
        done_symbols, done_parts = [], []
        while len(symbols):
            first = np.flatnonzero(np.diff(part, prepend=-1))
            rank = self._ranks[joined]
            best = np.minimum.reduceat(rank, first)
            count = np.diff(first, append=len(symbols))
            over = np.repeat(best == _NO_RANK, count)
            if over.any():
                done_symbols.append(symbols[over])
                done_parts.append(part[over])
                going = ~over
                symbols, part, joined, rank = symbols[going], part[going], joined[going], rank[going]
                live = best < _NO_RANK
                best, count = best[live], count[live]
            heads = np.flatnonzero(rank == np.repeat(best, count))
            heads = heads[np.diff(part[heads], prepend=-1) != 0]
            symbols[heads] = joined[heads]
            kept = np.ones(len(symbols), bool)
            kept[heads + 1] = False
            symbols, part, joined = symbols[kept], part[kept], joined[kept]
            heads -= np.arange(len(heads))
            changed = np.concatenate([heads, heads[heads > 0] - 1])
            joined[heads] = -1
            changed = changed[changed + 1 < len(symbols)]
            changed = changed[part[changed] == part[changed + 1]]
            joined[changed] = self._join(symbols[changed], symbols[changed + 1])
        symbols, part = np.concatenate(done_symbols), np.concatenate(done_parts)
        order = np.argsort(part, kind="stable")
        symbols, part = symbols[order], part[order]
        unknown = np.flatnonzero(symbols < 0)
        if len(unknown):
            spelled = [self._spelled(chr(-1 - s)) for s in symbols[unknown].tolist()]
            times = np.ones(len(symbols), np.int64)
            times[unknown] = [*map(len, spelled)]
            symbols, part = np.repeat(symbols, times), np.repeat(part, times)
            symbols[symbols < 0] = [i for x in spelled for i in x]
        flat = symbols.astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(part, minlength=len(parts)))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _merge_all(self, groups: list[list[str]]) -> list[bytes]:
        """Ids of each group of parts."""
        short = [p for g in groups for p in g if len(p) <= _SHORT]
        merged = iter(self.merge_together(short) if short else [])
        one = lambda p: next(merged) if len(p) <= _SHORT else array("I", self.merge(p)).tobytes()
        return [one(g[0]) if len(g) == 1 else b"".join(map(one, g)) for g in groups]

    def falls_apart(self, text: str) -> bool:
        """Whether the parts of a text are its words, each with the space before it."""
        return self.split_at_spaces and "  " not in text and SPACE not in text

    def encode_all(self, texts: list[str], as_is: bool = False) -> tuple[list[bytes], dict[str, bytes]]:
        """Ids of each text as little-endian unsigned 32-bit integers, and those of the words that were new.

        An empty text has no ids. ``as_is`` leaves out the space before a text.
        """
        spaced = texts if as_is or not self.prefix else [" " + t if t else t for t in texts]
        apart = [t.split(" ") if self.falls_apart(t) else None for t in spaced]
        known, every = self._words, set().union(*(a[1:] for a in apart if a))
        new = [w for w in every if w not in known]
        if len(known) + len(new) > _CACHE:
            known.clear()
            new = [*every]
        find = self._parts.findall
        ids = self._merge_all([find(SPACE + w) for w in new])
        fresh = dict(zip(new, ids, strict=True))
        known.update(fresh)
        # First words without a space before them, and texts with other spaces.
        loose = [find(t.replace(" ", SPACE)) if a is None else find(a[0]) for t, a in zip(spaced, apart, strict=True)]
        others, every = self._others, {p for parts in loose for p in parts}
        missing = [p for p in every if p not in others]
        if len(others) + len(missing) > _CACHE:
            others.clear()
            missing = [*every]
        others.update(zip(missing, self._merge_all([[p] for p in missing]), strict=True))
        out = []
        for parts, a in zip(loose, apart, strict=True):
            head = [others[p] for p in parts]
            out.append(b"".join(head + [known[w] for w in a[1:]] if a else head))
        for cache, added in ((known, new), (others, missing)):
            for x in added:
                if len(x) > _CACHE_WORD:
                    cache.pop(x)
        return out, fresh

    def of_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it, which are not remembered. Words may have other spaces inside."""
        return self._merge_all([self._parts.findall(SPACE + w.replace(" ", SPACE)) for w in words])

    def forget(self) -> None:
        """Forget the ids of all words."""
        self._words.clear()
        self._others.clear()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; an empty text has none."""
        return self.encode_all([text])[0][0]

    def raw(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for, gathered from the offset table in one step."""
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self._bytes[np.repeat(self._offsets[ids] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids without the space before it; each byte that is no UTF-8 becomes U+FFFD."""
        if not len(ids):
            return ""
        silent = np.flatnonzero(self.sizes[ids] == 0)
        # Control pieces have no text, but bytes on their two sides make no character.
        runs = [self.raw(x) for x in np.split(ids, silent)] if len(silent) else [self.raw(ids)]
        text = "".join([x.decode("utf-8", "each-byte") for x in runs])
        if self.prefix and text[:1] == " " and next(i for i in ids if self.sizes[i]) not in self._unstripped:
            return text[1:]
        return text


@cache
def pieces(path: str) -> Pieces:
    """One vocabulary for each worker process."""
    return Pieces(path)


def _digests(path: str, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        names = model.names
        agree = _agreement(model, path) if check else None
        for batch in few_bytes(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            every, fresh = model.encode_all(texts)
            counts, ids_sha, text_sha = [], [], []
            for raw in every:
                ids = np.frombuffer(raw, "<u4")
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join([names[i] for i in ids.tolist()]).encode()).hexdigest())
                text_sha.append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            if check:
                columns.append(pa.array(agree(texts, every, fresh), pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"][: len(columns)])

    return run


def _agreement(model: Pieces, path: str):
    """A function that tells which texts of a batch the sentencepiece library gives the same ids.

    Words that recur are merged once in a worker, so it is enough to compare what the agenda gave for this batch. The
    library puts a space before a text as words have one; texts that do not fall into such words are compared whole,
    and so is a batch with any difference, whose words are not remembered.
    """
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=path)

    def wanted(texts: list[str]) -> list[bytes]:
        return [array("I", x).tobytes() for x in library.encode(texts, num_threads=1)]

    def same(texts: list[str], ids: list[bytes], fresh: dict[str, bytes]) -> list[bool]:
        words = [w for w in fresh if w]
        if wanted(words) == [fresh[w] for w in words]:
            whole = [i for i, t in enumerate(texts) if not (model.prefix and model.falls_apart(" " + t))]
        else:
            model.forget()
            whole = [*range(len(texts))]
        out = [True] * len(texts)
        for i, want in zip(whole, wanted([texts[i] for i in whole]), strict=True):
            out[i] = ids[i] == want
        return out

    return same


def token_digests(docs: DataFrame, path: str, check: bool = False) -> DataFrame:
    """Each whole text encoded and decoded: (doc_id, n_tokens, ids_sha256, decoded_sha256), a row for each row.

    A null text counts as empty; that has no tokens. Null and repeated doc_ids pass through. Other columns are not
    read. Ids are hashed as decimal numbers joined by commas, the decoded text as UTF-8. ``check`` compares every batch
    with the sentencepiece library and adds ``agrees``, whether its ids are the same.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_digests(path, check), schema + (", agrees boolean" if check else ""))


def _tokens(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in few_bytes(batches, "text"):
            every, _ = model.encode_all([t or "" for t in batch.column("text").to_pylist()])
            ids = [np.frombuffer(x, "<u4") for x in every]
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate([np.empty(0, np.int32), *ids]).astype(np.int32)
            rest = pa.Table.from_batches([batch]).drop_columns("text")
            rest = rest.append_column("tokens", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
            yield from rest.combine_chunks().to_batches()

    return run


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with tokens (array<int>) in place of text. A null text is empty; a column named tokens is replaced."""
    rows = docs.drop("tokens")
    fields = [x for x in rows.schema if x.name != "text"]
    return rows.mapInArrow(_tokens(path), T.StructType([*fields, T.StructField("tokens", T.ArrayType(T.IntegerType()))]))


def _texts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            texts = [model.decode(np.array(x or [], np.int64)) for x in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def decoded(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` (doc_id, tokens) to (doc_id, text). Null tokens are an empty text."""
    return docs.select(F.col("doc_id").cast("long"), "tokens").mapInArrow(_texts(path), "doc_id long, text string")
