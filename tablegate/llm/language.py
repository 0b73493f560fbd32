"""Language identification by mixtures of languages.

Every language has a model of letter trigrams inside words. A document is a bag of words, each from one of the
languages; expectation-maximisation finds the proportions under which its words are likeliest. The set of languages is
chosen by penalised likelihood: starting from all, the language with the smallest proportion is dropped as long as the
likelihood falls by less than the penalty for a further parameter.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.llm.frames import few_bytes, few_rows, stored
from tablegate.llm.words import mix

UNKNOWN = "und"
#: The model is fitted on at most so many labelled documents, those with the smallest hashes of their doc_id.
SAMPLE = 20_000
BUCKETS = 1 << 15
ROUNDS = 8
#: Characters that count as words but are no letters: Roman numerals, fractions and the like.
_NUMBERS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and c.isalnum() and not c.isalpha())
_WORDS = re.compile(r"[^\W\d_]+")
_LETTERS = re.compile(f"[^\\W\\d_{re.escape(_NUMBERS)}]+")
_PART = 512
#: Words whose trigrams are looked up at once.
_BLOCK = 4096


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' letter trigrams, with marks for the two ends of each, and how many each word has."""
    codes = np.frombuffer(f"<{'><'.join(words)}>".encode("utf-32-le"), "<u4").astype(np.uint64)
    inside = (codes[:-2] != ord(">")) & (codes[1:-1] != ord(">"))
    # Three code points of 21 bits fit into 64 bits.
    triples = codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:]
    return (mix(triples[inside]) % np.uint64(BUCKETS)).astype(np.int64), np.fromiter(map(len, words), np.int64, len(words))


def words(text: str | None) -> list[str]:
    """Runs of letters. The pattern that knows number characters is slow, so it only reads texts that have some."""
    lower = (text or "").lower()
    found = _WORDS.findall(lower)
    return found if not found or "".join(found).isalpha() else _LETTERS.findall(lower)


@dataclass
class Model:
    languages: list[str]
    #: Log-probability of each trigram bucket in each language.
    table: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        """Log-likelihood of each word in each language; a word has a letter at least."""
        out = np.empty((len(words), self.table.shape[1]))
        for k in range(0, len(words), _BLOCK):
            buckets, sizes = grams(words[k : k + _BLOCK])
            out[k : k + _BLOCK] = np.add.reduceat(self.table[buckets], np.cumsum(sizes) - sizes)
        return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of each language in each batch, as one block of numbers."""
    for batch in few_bytes(few_rows(batches, 5000), "text", 4 << 20):
        bags: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            bags.setdefault(lang, Counter()).update(words(text))
        out = []
        for bag in bags.values():
            if not bag:
                out.append([0] * BUCKETS)
                continue
            buckets, sizes = grams(list(bag))
            times = np.repeat(np.fromiter(bag.values(), np.int64, len(bag)), sizes)
            out.append(np.bincount(buckets, times, BUCKETS).astype(np.int64).tolist())
        columns = [pa.array(list(bags), pa.string()), pa.array(out, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "counts"])


def held_out(folds: int = 5):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the documents (doc_id, text, lang) that are not held out and have a language.

    At most ``sample`` of them, those with the smallest hashes of doc_id. Null languages and doc_ids teach nothing.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    ids = stored(known.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = known.select("doc_id", "lang", "text").join(F.broadcast(ids.distinct()), "doc_id", "left_semi")
    counts = rows.select("lang", "text").mapInArrow(_counts, "lang string, counts array<long>")
    counts = counts.select("lang", F.posexplode("counts").alias("gram", "n")).where("n > 0")
    found = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).orderBy("lang", "gram").toArrow()
    langs, grams_, n = (found.column(c).to_pylist() for c in ("lang", "gram", "n"))
    languages = sorted(set(langs))
    table = np.full((BUCKETS, max(1, len(languages))), 0.5)
    table[grams_, [languages.index(x) for x in langs]] += n
    return Model(languages, np.log(table / table.sum(0)))


def proportions(
    likelihoods: np.ndarray, counts: np.ndarray, starts: np.ndarray, allowed: np.ndarray, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages and log-likelihood for each document.

    ``likelihoods``: for each word of each document, relative to its best language; ``starts``: where documents begin.
    """
    sizes = np.diff(np.append(starts, len(counts)))
    total = np.add.reduceat(counts, starts)
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(rounds):
        joint = likelihoods * np.repeat(share, sizes, axis=0)
        both = joint.sum(1)
        joint *= (counts / np.maximum(both, 1e-300))[:, None]
        share = np.add.reduceat(joint, starts) / total[:, None]
    both = (likelihoods * np.repeat(share, sizes, axis=0)).sum(1)
    return share, np.add.reduceat(counts * np.log(np.maximum(both, 1e-300)), starts)


def select(likelihoods: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Proportions in each document's chosen set of languages."""
    total = np.add.reduceat(counts, starts)
    penalty = 0.5 * np.log(total + 1)
    allowed = np.ones((len(starts), likelihoods.shape[1]))
    share, best = proportions(likelihoods, counts, starts, allowed)
    for _ in range(likelihoods.shape[1] - 1):
        least = np.where(allowed > 0, share, 2.0).argmin(1)
        fewer = allowed.copy()
        fewer[np.arange(len(starts)), least] = 0
        last = fewer.sum(1) == 0
        fewer[last] = allowed[last]
        tried, value = proportions(likelihoods, counts, starts, fewer)
        better = ~last & (best - value < penalty)
        if not better.any():
            break
        allowed[better], share[better], best[better] = fewer[better], tried[better], value[better]
    return share


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The largest language of each text and its proportion; ``und`` and 0 without a letter or a learned language."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not model.languages:
        return names, scores
    for s in range(0, len(texts), _PART):
        bags = [Counter(words(t)) for t in texts[s : s + _PART]]
        at = [k for k, bag in enumerate(bags) if bag]
        if not at:
            continue
        place: dict[str, int] = {}
        where = np.array([place.setdefault(w, len(place)) for k in at for w in bags[k]])
        counts = np.array([n for k in at for n in bags[k].values()], np.float64)
        starts = np.cumsum([0, *(len(bags[k]) for k in at[:-1])])
        logs = model.scores(list(place))
        share = select(np.exp(logs - logs.max(1, keepdims=True))[where], counts, starts)
        best = share.argmax(1)
        for row, k in enumerate(at):
            names[s + k], scores[s + k] = model.languages[best[row]], float(min(1.0, share[row, best[row]]))
    return names, scores


def _identify(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_bytes(few_rows(batches), "text"):
            found, scores = predict(model, batch.column("text").to_pylist())
            more = [pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "lang_pred", "score"])

    return run


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score; only ``text`` is looked at. Columns of these names are replaced."""
    rows = docs.drop("lang_pred", "score")
    schema = T.StructType([*rows.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_identify(model), schema)


def languages(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text, lang) to (doc_id, held_out, lang_pred, score), a row for each row.

    ``score`` is the proportion of the predicted language in the mixture. A text that is null or has no letter is
    ``und`` with score 0, as is every text if there is nothing to learn from. A null doc_id is not held out and
    teaches nothing. Equal texts get equal answers. Other columns are not read. An empty table gives no rows.
    """
    model = fit(docs)
    out = identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
