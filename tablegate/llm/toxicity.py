"""Toxic spans and document scores from a linear-chain conditional random field.

Only documents are labelled. Words, or runs of letters in them, that stand in toxic documents far more often than in others
label the tokens of the training documents, and a two-state chain learns from them when a token is toxic, from the classes of a word and
its neighbours and from the state before. Marginals from the forward-backward algorithm give the toxic spans; their
largest value and their sum in a document give its score by a logistic curve fitted to the labels.

The chain runs over pieces of 64 words, so a text of any length is scored whole. Pieces without any word of a class
above 0 all have the same marginals for their length, which are computed once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.frames import few_rows, stored
from tablegate.llm.words import shingles, word_hashes

#: The model is fitted on at most so many labelled documents, those with the smallest hashes of their doc_id.
SAMPLE = 20_000
#: Words in the lexicon at most, those with the surest association, and pieces the chain is trained on.
LEXICON, PIECES = 10_000, 4_000
PIECE = 64
TOXIC_AT = 0.7
#: Root of the likelihood ratio that a word needs, documents it is in, and lower ends of the log-odds of classes 1 to 3.
_SURE, _SUPPORT, _CLASSES = 5.0, 5, (0.7, 2.0, 4.0)
_WORD = re.compile(r"[^\W\d_]+")
_KINDS = 4
_RUNS = (4, 5)
_CACHE = 1 << 19


def held_out(folds: int = 3, fold: int = 1):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold


def parts(word: str) -> list[str]:
    """What may tell of a word: itself, and its runs of four and five letters with marks for its ends."""
    raw = f"<{word}>"
    return [raw, *(raw[k : k + n] for n in _RUNS for k in range(len(raw) - n + 1) if n < len(raw))]


@dataclass
class Model:
    #: Classes of words and of runs of letters; a word has the highest class of its parts.
    lexicon: dict[str, int]
    #: Weights of the toxic state for the class of the word before, the word, and the next; changes of state; the start.
    emit: np.ndarray = field(default_factory=lambda: np.zeros((3, _KINDS)))
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    #: Intercept and weights of the largest marginal's log-odds and of the logarithm of their sum.
    curve: np.ndarray = field(default_factory=lambda: np.zeros(3))

    def __post_init__(self) -> None:
        self._plain: dict[int, np.ndarray] = {}
        self._known: dict[str, int] = {}

    def kind(self, word: str) -> int:
        """The class of a word in lower case."""
        found = self._known.get(word)
        if found is None:
            found = max(self.lexicon.get(x, 0) for x in parts(word))
            if len(self._known) >= _CACHE:
                self._known.clear()
            self._known[word] = found
        return found

    def plain(self, size: int) -> np.ndarray:
        """Marginals of a piece without a word of a class above 0."""
        if size not in self._plain:
            self._plain[size] = marginals(self, np.zeros((1, size), np.int8), np.array([size]))[0]
        return self._plain[size]


def _features(kinds: np.ndarray) -> list[np.ndarray]:
    """Classes of the word before, the word, and the next, for rows of words."""
    none = np.zeros((len(kinds), 1), kinds.dtype)
    return [np.concatenate([none, kinds[:, :-1]], 1), kinds, np.concatenate([kinds[:, 1:], none], 1)]


def _forward_backward(model: Model, kinds: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the states (piece, word, state) and of the steps (piece, word, from, to)."""
    n, width = kinds.shape
    score = np.zeros((n, width, 2))
    for weights, part in zip(model.emit, _features(kinds), strict=True):
        score[:, :, 1] += weights[part]
    local, move = np.exp(np.clip(score, -30, 30)), np.exp(np.clip(model.move, -30, 30))
    alive = np.arange(width)[None, :] < sizes[:, None]
    ahead, back = np.zeros((n, width, 2)), np.ones((n, width, 2))
    ahead[:, 0] = local[:, 0] * np.exp(np.clip(model.start, -30, 30))
    ahead[:, 0] /= ahead[:, 0].sum(1, keepdims=True)
    for t in range(1, width):
        x = (ahead[:, t - 1] @ move) * local[:, t]
        ahead[:, t] = x / x.sum(1, keepdims=True)
    for t in range(width - 2, -1, -1):
        x = (back[:, t + 1] * local[:, t + 1]) @ move.T
        back[:, t] = np.where(alive[:, t + 1, None], x / x.sum(1, keepdims=True), 1.0)
    state = ahead * back
    state /= state.sum(2, keepdims=True)
    step = ahead[:, :-1, :, None] * move * (local * back)[:, 1:, None, :]
    step /= step.sum((2, 3), keepdims=True)
    return state * alive[:, :, None], step * alive[:, 1:, None, None]


def marginals(model: Model, kinds: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """For each piece the probability of each word to be toxic."""
    state = _forward_backward(model, kinds, sizes)[0][:, :, 1]
    return [s[:k] for s, k in zip(state, sizes.tolist(), strict=True)]


def train_chain(model: Model, kinds: np.ndarray, sizes: np.ndarray, toxic: np.ndarray, rounds: int = 150) -> None:
    """Fit the chain to labelled words by gradient ascent on the conditional likelihood, with a small penalty."""
    alive = np.arange(kinds.shape[1])[None, :] < sizes[:, None]
    features = _features(kinds)
    labels = (toxic & alive).astype(float)
    pairs = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            pairs[a, b] = ((toxic[:, :-1] == a) & (toxic[:, 1:] == b) & alive[:, 1:]).sum()
    first, square, total = None, None, max(1, alive.sum())
    for step_no in range(1, rounds + 1):
        state, step = _forward_backward(model, kinds, sizes)
        rest = labels - state[:, :, 1]
        emit = np.stack([np.bincount(f[alive], rest[alive], _KINDS) for f in features])
        start = np.array([0.0, rest[:, 0].sum()])
        move = pairs - step.sum((0, 1))
        move[0, 0] = 0
        slope = np.concatenate([emit.ravel(), move.ravel(), start]) / total
        slope -= 1e-4 * np.concatenate([model.emit.ravel(), model.move.ravel(), model.start])
        first = slope if first is None else 0.9 * first + 0.1 * slope
        square = slope**2 if square is None else 0.99 * square + 0.01 * slope**2
        change = 0.15 * first / (np.sqrt(square) + 1e-9) / np.sqrt(1 + step_no / 50)
        model.emit = model.emit + change[:12].reshape(3, _KINDS)
        model.move = model.move + change[12:16].reshape(2, 2)
        model.start = model.start + change[16:]


def kinds_of(model: Model, text: str | None) -> np.ndarray:
    """The class of each word."""
    found = _WORD.findall(text or "")
    return np.fromiter(map(model.kind, map(str.lower, found)), np.int8, len(found))


def document_marginals(model: Model, documents: list[np.ndarray]) -> list[np.ndarray]:
    """The probability of each word of each document to be toxic."""
    out, where, todo = [], [], []
    for d, kinds in enumerate(documents):
        parts = [kinds[k : k + PIECE] for k in range(0, len(kinds), PIECE)]
        out.append([model.plain(len(p)) for p in parts])
        for k, p in enumerate(parts):
            if p.any():
                where.append((d, k))
                todo.append(p)
    for s in range(0, len(todo), 4096):
        part = todo[s : s + 4096]
        sizes = np.array([len(p) for p in part])
        table = np.zeros((len(part), PIECE), np.int8)
        for i, p in enumerate(part):
            table[i, : len(p)] = p
        for (d, k), p in zip(where[s : s + 4096], marginals(model, table, sizes), strict=True):
            out[d][k] = p
    return [np.concatenate(x) if x else np.zeros(0) for x in out]


def _summary(p: np.ndarray) -> tuple[float, float]:
    """Log-odds of the largest marginal and the logarithm of their sum; a text without words has the least of both."""
    if not len(p):
        return -14.0, -14.0
    top = float(np.clip(p.max(), 1e-6, 1 - 1e-6))
    return float(np.log(top / (1 - top))), float(np.log(max(p.sum(), 1e-6)))


def scores(model: Model, found: list[np.ndarray]) -> np.ndarray:
    x = np.array([(1.0, *_summary(p)) for p in found]).reshape(-1, 3)
    return 1 / (1 + np.exp(-np.clip(x @ model.curve, -30, 30)))


def _fit_curve(model: Model, found: list[np.ndarray], toxic: np.ndarray) -> None:
    """Logistic regression by Newton steps; weights that would lower the score are left at zero."""
    x = np.array([(1.0, *_summary(p)) for p in found])
    use = [0, 1, 2]
    while True:
        w = np.zeros(3)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x[:, use] @ w[use], -30, 30)))
            slope = x[:, use].T @ (toxic - p) - 0.1 * w[use]
            bend = (x[:, use] * (p * (1 - p))[:, None]).T @ x[:, use] + 0.1 * np.eye(len(use))
            w[use] += np.clip(np.linalg.solve(bend, slope), -2, 2)
        wrong = [k for k in use[1:] if w[k] < 0]
        if not wrong:
            break
        use.remove(wrong[0])
    model.curve = w


def _smallest_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in few_rows(batches):
        found = word_hashes(batch.column("text").cast(pa.binary()).to_pylist())
        low = [int(shingles(w).min() >> np.uint64(1)) if len(w) else -1 for w in found]
        columns = [batch.column("doc_id"), batch.column("toxic"), pa.array(low, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "key"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each batch, the documents of either label that have a word or a run of letters."""
    for batch in batches:
        bags = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            seen = {w.lower() for w in _WORD.findall(text or "")}
            bags[toxic].update({x for w in seen for x in parts(w)})
        every = list(bags[0] | bags[1])
        columns = [pa.array(every, pa.string()), *(pa.array([b[w] for w in every], pa.int64()) for b in bags)]
        yield pa.RecordBatch.from_arrays(columns, ["word", "clean", "toxic"])


def _sequences(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [kinds_of(model, t).tobytes() for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("toxic"), pa.array(kinds, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "kinds"])

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from labels (doc_id, toxic) of documents (doc_id, text) that are not held out.

    At most ``sample`` labelled documents, those with the smallest hashes of doc_id; a document with several labels
    is toxic if one says so. Without documents of both labels the model knows no toxic word.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where("toxic in (0, 1)")
    known = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    # Near copies would make any of their words look toxic or not: of texts with one smallest shingle, one stays.
    one = rows.mapInArrow(_smallest_shingle, "doc_id long, toxic int, key long").groupBy("key")
    known = stored(one.agg(F.min(F.struct("doc_id", "toxic")).alias("x")).select("x.*"))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    model = Model({})
    if len(sizes) < 2:
        model.curve = np.array([-3.0 if sizes.get(1, 0) == 0 else 0.0, 0.0, 0.0])
        return model
    counts = rows.select("text", "toxic").mapInArrow(_word_counts, "word string, clean long, toxic long")
    counts = counts.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1.0))
    share = sizes[1] / (sizes[0] + sizes[1])
    # Signed root of the likelihood ratio of the word's split over the labels against that of all documents.
    both = F.col("toxic") + F.col("clean")
    ratio = F.col("toxic") * F.log(F.greatest("toxic", F.lit(1)) / (both * share))
    ratio = ratio + F.col("clean") * F.log(F.greatest("clean", F.lit(1)) / (both * (1 - share)))
    counts = counts.withColumn("odds", odds).withColumn("sure", F.sqrt(F.greatest(2 * ratio, F.lit(0.0))))
    counts = counts.where((F.col("sure") >= _SURE) & (F.col("toxic") >= _SUPPORT) & (F.col("odds") >= _CLASSES[0]))
    for r in counts.orderBy(F.col("sure").desc(), "word").limit(LEXICON).collect():
        model.lexicon[r["word"]] = sum(r["odds"] >= c for c in _CLASSES)
    found = rows.mapInArrow(_sequences(model), "doc_id long, toxic int, kinds binary").orderBy("doc_id", "kinds").collect()
    documents = [np.frombuffer(r["kinds"], np.int8) for r in found]
    toxic = np.array([r["toxic"] for r in found])
    _train(model, documents, toxic)
    _fit_curve(model, document_marginals(model, documents), toxic)
    return model


def _train(model: Model, documents: list[np.ndarray], toxic: np.ndarray) -> None:
    """Train the chain on pieces with words of a class, and on as many others."""
    with_words, others = [], []
    for kinds, label in zip(documents, toxic.tolist(), strict=True):
        for k in range(0, len(kinds), PIECE):
            p = kinds[k : k + PIECE]
            (with_words if p.any() else others).append((p, label))
    pieces = with_words[:PIECES] + others[: min(PIECES, len(with_words) + 100)]
    table = np.zeros((len(pieces), PIECE), np.int8)
    for i, (p, _) in enumerate(pieces):
        table[i, : len(p)] = p
    said = np.array([label for _, label in pieces], bool)[:, None] & (table >= 2)
    train_chain(model, table, np.array([len(p) for p, _ in pieces]), said)
    model._plain.clear()


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            texts = batch.column("text").to_pylist()
            found = document_marginals(model, [kinds_of(model, t) for t in texts])
            spans = [_spans(t, p) if len(p) and p.max() >= 0.5 else [] for t, p in zip(texts, found, strict=True)]
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32()), ("toxic", pa.float64())]))
            columns = [batch.column("doc_id"), pa.array(scores(model, found)), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "spans"])

    return run


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of words that are toxic with probability a half or more, in code points, with their largest probability."""
    out: list[dict] = []
    last = -2
    for k, m in enumerate(_WORD.finditer(text)):
        if p[k] >= 0.5:
            if k == last + 1:
                out[-1] |= {"stop": m.end(), "toxic": max(out[-1]["toxic"], float(p[k]))}
            else:
                out.append({"begin": m.start(), "stop": m.end(), "toxic": float(p[k])})
            last = k
    return out


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text) to (doc_id, score, spans), a row for each row; only ``text`` is looked at."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_score(model), "doc_id long, score double, spans array<struct<begin:int,stop:int,toxic:double>>")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents (doc_id, text) and labels (doc_id, toxic) to (doc_id, held_out, score, predicted, spans).

    A row for each document row. A null or empty text, or one without words, has the lowest score there is. A null doc_id is
    not held out and teaches nothing; null labels neither. Equal texts get equal scores. Other columns are not read.
    Without labels of both kinds every score is the same. An empty table gives no rows.
    """
    out = scored(docs, fit(docs, labels))
    predicted = (F.col("score") >= TOXIC_AT).cast("int").alias("predicted")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", predicted, "spans")
