"""Byte-pair encoding and decoding with the merges of a public tokenizer file.

The encoder does not merge pairs. It takes the longest token at each place and keeps it only if it is compatible with
the token before it, that is, if merging would also end with a boundary between the two; else it tries the next
shorter token, and goes back one token when none is left. Places that were given up are marked, so each is entered
once and the work is linear in the text. Longest matches come from an Aho-Corasick automaton over the vocabulary. The
decoder copies byte ranges that an offset table names.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.llm.frames import few_bytes, few_rows

# Fixed value: the pattern that splits text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Unicode white space, which is what \s means in that pattern.
_BLANK = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WORDS = regex.compile(PATTERN.replace("[^\\s", f"[^{_BLANK}").replace("\\S", f"[^{_BLANK}]").replace("\\s", f"[{_BLANK}]"))
#: White space before a space: only there a space may be no start of a word. A superset of the above is safe.
_ODD_SPACE = re.compile(r"\s\x20")
_SAFE_SPACE = re.compile(r"(?<=\S)\x20")
#: Pieces whose tokens are kept in a worker, and characters of the longest one.
_CACHE, _CACHE_PIECE = 1 << 19, 64
#: Pairs of tokens that are remembered.
_FITS = 1 << 17
#: What a worker remembers from batch to batch where rows keep their other columns.
_KEPT = 1 << 16


def _byte_letters() -> dict[str, int]:
    """Bytes as the vocabulary writes them: printable Latin-1 as itself, the others moved up from 256 in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(moved)}


def split(text: str) -> list[str]:
    """A text cut at the spaces that begin a word for sure, without these."""
    return text.split(" ") if _ODD_SPACE.search(text) is None else _SAFE_SPACE.split(text)


class Codec:
    """The tokens and merges of a file of the tokenizers library of the byte-level kind without a normalizer."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind, split = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        vocab = {t: i for t, i in kind["vocab"].items() if t not in self.special}
        self.texts: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.texts[i] = raw(token)
        for token, i in self.special.items():
            self.texts[i] = token.encode()
        # Ranks: single bytes come first, then tokens in the order of their merges.
        pairs = [m.split(" ") if isinstance(m, str) else m for m in kind["merges"]]
        order = [vocab[t] for t in vocab if len(self.texts[vocab[t]]) == 1]
        order += [vocab[a + b] for a, b in pairs]
        self.ids = order
        rank = {i: r for r, i in enumerate(order)}
        self.parts: list[tuple[int, int]] = [(r, r) for r in range(len(order))]
        self.merged: dict[tuple[int, int], int] = {}
        for a, b in pairs:
            pair, r = (rank[vocab[a]], rank[vocab[b]]), rank[vocab[a + b]]
            self.merged[pair], self.parts[r] = r, pair
        self.rank_of = {self.texts[i]: r for r, i in enumerate(order)}
        self.sizes = [len(self.texts[i]) for i in order]
        self.longest_size = max(self.sizes)
        self.shorter = [self._prefix(self.texts[i]) for i in order]
        self.matches = ahocorasick.Automaton()
        for text, r in self.rank_of.items():
            self.matches.add_word(text.decode("latin-1"), r)
        self.matches.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.offsets = np.cumsum([0, *map(len, self.texts)])
        self.bytes = np.frombuffer(b"".join(self.texts), np.uint8)
        #: Ids of words of the pattern that are parts of pieces, and of pieces between spaces.
        self.words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.stop = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def _prefix(self, text: bytes) -> int:
        """The longest token that a token starts with, other than itself; -1 for single bytes."""
        return next((r for n in range(len(text) - 1, 0, -1) if (r := self.rank_of.get(text[:n])) is not None), -1)

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging keeps the boundary between two tokens.

        Undo the later of the two tokens' last merges, again and again. The boundary falls if at some point the pieces
        that touch it would have merged with each other before the merge that was undone last.
        """
        key = (left, right)
        if (known := self.fits.get(key)) is not None:
            return known
        before, good = len(self.ids), True
        while True:
            if self.merged.get((left, right), before) < before:
                good = False
                break
            outer, inner = self.parts[left][1], self.parts[right][0]
            if outer == left and inner == right:
                break
            # Of two equal ranks the left one merges first, so the right one is undone first.
            if outer != left and (left > right or inner == right):
                before, left = left, outer
            else:
                before, right = right + 1, inner
        if len(self.fits) >= _FITS:
            self.fits.clear()
        self.fits[key] = good
        return good

    def forget(self, over: int = 0) -> None:
        """Empty each memory of pairs, words and pieces that holds more than ``over`` of them."""
        for known in (self.fits, self.words, self.known):
            if len(known) > over:
                known.clear()

    def longest(self, text: str, at: int) -> int:
        """The longest token at a place of a text of bytes."""
        return next(self.matches.iter_long(text, at, min(len(text), at + self.longest_size)))[1]

    def merge(self, text: bytes) -> list[int]:
        """Ids of one piece, as merging would give them."""
        if (whole := self.rank_of.get(text)) is not None:
            return [self.ids[whole]]
        letters, end = text.decode("latin-1"), len(text)
        sizes, fits, longest, compatible = self.sizes, self.fits, self.longest, self.compatible
        out: list[int] = []
        open_at = bytearray(b"\x01") * (end + 1)
        at, last, token = 0, -1, longest(letters, 0)
        while at < end:
            after = at + sizes[token]
            if open_at[after] and (last < 0 or (compatible(last, token) if (good := fits.get((last, token))) is None else good)):
                out.append(token)
                at, last = after, token
                token = longest(letters, at) if at < end else -1
                continue
            token = self.shorter[token]
            if token < 0:
                # No token fits here after ``last``: never come back to this place.
                open_at[at] = 0
                token = out.pop()
                at -= sizes[token]
                last = out[-1] if out else -1
        return [self.ids[r] for r in out]

    def _word(self, word: str, known: Callable[[str], bytes | None]) -> bytes:
        got = self.words.get(word)
        # A word may be known as a piece.
        if got is None and (got := known(word)) is None:
            got = array("I", self.merge(word.encode())).tobytes()
            if len(word) <= _CACHE_PIECE:
                if len(self.words) >= _CACHE:
                    self.words.clear()
                self.words[word] = got
        return got

    def piece(self, piece: str, known: Callable[[str], bytes | None]) -> bytes:
        """Ids of what begins at a safe space and ends before the next one; only its words are remembered.

        ``known`` gives the ids of pieces that the caller remembers.
        """
        words = _WORDS.findall(piece)
        if len(words) == 1:
            # It is remembered once, as a piece.
            return self.words.pop(piece, None) or array("I", self.merge(piece.encode())).tobytes()
        return b"".join([self._word(w, known) for w in words])

    def _piece(self, piece: str) -> bytes:
        out = self.piece(piece, self.known.get)
        if len(piece) <= _CACHE_PIECE:
            if len(self.known) >= _CACHE:
                self.known.clear()
            self.known[piece] = out
        return out

    def _plain(self, text: str) -> bytes:
        first, *rest = split(text)
        known = self.known
        out = [self._piece(first)] if first else []
        for word in rest:
            piece = " " + word
            got = known.get(piece)
            out.append(self._piece(piece) if got is None else got)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. Special tokens in the text are special tokens."""
        if self.stop is None or self.stop.search(text) is None:
            return self._plain(text)
        out, at = [], 0
        for m in self.stop.finditer(text):
            out += [self._plain(text[at : m.start()]), np.array([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, gathered from the offset table in one step."""
        starts = self.offsets[ids]
        sizes = self.offsets[ids.astype(np.int64) + 1] - starts
        ends = np.cumsum(sizes)
        if not len(ids):
            return b""
        return self.bytes[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()


@cache
def codec(path: str) -> Codec:
    """One codec for each worker process."""
    return Codec(path)


def text_of(raw: bytes) -> bytes:
    """Bytes as UTF-8, with the replacement character for what is none."""
    return raw.decode("utf-8", "replace").encode()


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_codec = codec(path)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column("text").to_pylist():
                ids = with_codec.encode(text or "")
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(text_of(with_codec.decode(np.frombuffer(ids, "<u4")))).hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """Each whole text encoded and decoded: (doc_id, n_tokens, ids_sha256, decoded_sha256), a row for each row.

    A null text counts as empty; that has no tokens. Null and repeated doc_ids pass through. Other columns are not
    read. Ids are hashed as little-endian unsigned 32-bit integers, the decoded text as UTF-8.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_digests(path), schema)


def _tokens(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_codec = codec(path)
        for batch in few_bytes(few_rows(batches), "text"):
            with_codec.forget(_KEPT)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = [np.frombuffer(with_codec.encode(t), "<u4") for t in texts]
            back = [with_codec.decode(x) == t.encode() for x, t in zip(ids, texts, strict=True)]
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate([np.empty(0, np.int32), *ids]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            rest = pa.Table.from_batches([batch]).drop_columns("text")
            rest = rest.append_column("n_tokens", pa.array(np.diff(ends), pa.int64())).append_column("tokens", tokens)
            yield from rest.append_column("round_trip", pa.array(back)).combine_chunks().to_batches()
        # Workers live on and serve other steps.
        with_codec.forget()

    return run


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with n_tokens, tokens (array<int>) and round_trip, whether decoding gives the text, in place of text.

    A null text is empty. Other columns pass through, but for ones of these three names, which are replaced.
    """
    rows = docs.drop("n_tokens", "tokens", "round_trip")
    kept = [x for x in rows.schema if x.name != "text"]
    more = [("n_tokens", T.LongType()), ("tokens", T.ArrayType(T.IntegerType())), ("round_trip", T.BooleanType())]
    return rows.mapInArrow(_tokens(path), T.StructType([*kept, *(T.StructField(*x) for x in more)]))


def _texts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_codec = codec(path)
        for batch in batches:
            texts = [text_of(with_codec.decode(np.array(x or [], np.int64))).decode() for x in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def decoded(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` (doc_id, tokens) to (doc_id, text). Null tokens are an empty text."""
    return docs.select("doc_id", "tokens").mapInArrow(_texts(path), "doc_id long, text string")
