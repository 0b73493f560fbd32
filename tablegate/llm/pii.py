"""Personal data in texts: candidates from wide patterns, judged by gradient-boosted trees.

Strict patterns with their checks give the base spans, which always stay. Wider patterns propose further spans that may
overlap. Boosted trees look only at the context of a span, so an obfuscated span looks like a base span that stands where
it does. Base spans are examples of personal data; spans that cannot be any (failed octets or checksums, impossible numbers) and plain
numbers and words are examples of other things. What the wide patterns propose beyond these is not labelled: it counts
with the probability that Elkan and Noto's estimate gives it from how often base spans stand in such a context. On
documents kept apart, the threshold of each kind is set so that nearly all base spans would be found by their context.
Spans above it that overlap no base span are added.

Every document teaches. Examples become bins of their features, equal ones a row with their number. A level of a tree
takes one pass over these rows, which adds up slopes and bends for each node, feature and bin; only such sums reach the
driver. They are sums of integers, so they do not depend on how rows are spread.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.frames import few_rows, stored

KINDS = ("email", "ip", "card", "phone")
#: Examples for each document of ``sampled`` on average, those with the smallest hashes of document and place.
EXAMPLES = 20
TREES, DEPTH, RATE, BINS = 40, 3, 0.3, 16
#: Slopes, bends and probabilities are added up in this unit.
_UNIT = 2.0**-20
#: Rows of distinct binned examples that the driver holds itself; more stay in a table, with the same sums.
FEW = 50_000
#: Share of the base spans kept apart that must lie above a threshold, base spans that this needs, and the threshold of
#: rarer kinds, which is also the highest there is.
RECALL, EVIDENCE, LIKELY = 0.95, 30, 0.5
_STEPS = 1 << 14
#: Plain numbers and words of a document that are examples of other things, at most.
_PLAIN_NUMBERS, _PLAIN_WORDS = 8, 4

# The strict patterns.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")

#: Patterns that propose spans of each kind.
_WIDE = {
    "email": re.compile(r"(?<!\S)[\w.%+-]{1,64}(?:@|\x20?[\[(]at[\])]\x20?)[\w-]{1,63}(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[\w-]{1,63}){1,8}"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,4}(?:[.:][0-9]{1,4}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20.-]?[0-9]){8,15}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+|00)?[0-9]{0,3}[\x20.-]?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
}
_ANY = re.compile(r"[0-9@]|[\[(]at[\])]")
_NEAR = re.compile(r"[^\W\d_]+")
_NUMBER = re.compile(r"(?<![\w.@+-])[0-9]{1,6}(?![\w@])")
_OBSCURED = re.compile(r"\x20?[\[(](at|dot)[\])]\x20?")
_STAMP = re.compile(r"(19|20)[0-9]{2}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])([01][0-9]|2[0-3])[0-5][0-9]")

#: Words that tell of a kind, and words that tell of other numbers and names. They are also the prior: each of them is an
#: example, so tables with few base spans or none have a model as well.
_CUES = {
    "email": frozenset("mail email write contact address reach reply".split()),
    "ip": frozenset("ip host server address client ping login".split()),
    "card": frozenset("card visa mastercard amex credit debit pay charge".split()),
    "phone": frozenset("call phone tel telephone mobile cell fax sms ring dial contact".split()),
}
_OTHER = frozenset("id order item part no number isbn serial version ref invoice total sku page row code".split())
_FAR = 9


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain, found from each @."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > end and _LOCAL.match(text, begin - 1):
            begin -= 1
        found = _DOMAIN.match(text, at) if begin < at else None
        if found:
            out.append((begin, found.end()))
            end = found.end()
        at = text.find("@", max(at + 1, end))
    return out


def passes(kind: str, span: str) -> bool:
    """The strict check on what a strict pattern matched."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in span.split("."))
    digits = _digits(span)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def strict(text: str) -> list[tuple[int, int, int]]:
    """Base spans (start, kind, end), sorted; matches that fail their check are dropped."""
    if _ANY.search(text) is None:
        return []
    out = [(s, 0, e) for s, e in _emails(text)]
    for k, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if passes(KINDS[k], m[0])]
    return sorted(out)


def proposed(text: str) -> list[tuple[int, int, int]]:
    """Candidate spans (start, kind, end) of the wide patterns, sorted; spans may overlap."""
    if _ANY.search(text) is None:
        return []
    return sorted((m.end() - len(m[0].lstrip(" .-")), k, m.end()) for k, kind in enumerate(KINDS) for m in _WIDE[kind].finditer(text))


def refuted(kind: str, span: str) -> bool:
    """Whether a candidate cannot be of its kind, however it is written."""
    if kind == "email":
        local, _, domain = _OBSCURED.sub(lambda m: "@" if m[1] == "at" else ".", span).partition("@")
        labels = domain.split(".")
        wrong = any(x.startswith("-") or x.endswith("-") for x in labels) or local.strip(".") != local or ".." in local
        return wrong or len(labels[-1]) < 2 or labels[-1].isdigit()
    if kind == "ip":
        return any(int(x) > 255 for x in re.findall(r"[0-9]+", span))
    digits = _digits(span)
    if kind == "card":
        return digits[:1] == "0" or len(set(digits)) == 1 or _STAMP.match(digits) is not None
    ten = digits[-10:]
    # North American numbers, which stand alone or after 1, have no area or exchange that starts with 0 or 1.
    american = digits[:-10].lstrip("0") in ("", "1")
    return len(set(ten)) == 1 or (american and (ten[0] in "01" or ten[3] in "01"))


def fails(kind: str, span: str) -> bool:
    """Whether a candidate has a checksum and fails it."""
    digits = _digits(span) if kind == "card" else ""
    return len(digits) > 6 and not luhn(digits)


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Context of a span, and whether a card number fails its checksum.

    Nothing in it tells how the span is written, so it holds for base and obscured spans alike.
    """
    before, after = text[max(0, start - 40) : start], text[end : end + 40]
    left = [w.lower() for w in _NEAR.findall(before)[:-5:-1]]
    right = [w.lower() for w in _NEAR.findall(after)[:2]]
    words = [*(left + ["", ""])[:2], *(right + [""])[:1]]
    near = [int.from_bytes(hashlib.blake2b(w.encode(), digest_size=1).digest(), "big") if w else -1 for w in words]
    around = before + after
    return [
        kind,
        *(min((k for k, w in enumerate(left + right) if w in known), default=_FAR) for known in (_CUES[KINDS[kind]], _OTHER)),
        sum("0" <= c <= "9" for c in around) / max(1, len(around)),
        len(left),
        len(right),
        ord(before[-1:] or "\n") & 127,
        ord(after[:1] or "\n") & 127,
        *near,
        # Below the others, as a cut lies below the values that nearly all have.
        -fails(KINDS[kind], text[start:end]),
    ]


@dataclass
class Trees:
    """Gradient-boosted regression trees for a yes or no, over binned features."""

    edges: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0
    #: For each tree, by node: (feature, bin, value); children of node i are 2i+1 and 2i+2.
    trees: list[list[tuple[int, int, float]]] = field(default_factory=list)

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [_edges(*np.unique(c, return_counts=True)) for c in x.T]
        rows = {"bins": self._bins(x), "n": np.ones(len(y), np.int64)}
        return self.grown(lambda f: f(rows), lambda r: (y, np.ones(len(y))))

    def grown(self, total: Callable, aim: Callable) -> Trees:
        """Trees for binned rows. ``total`` adds up an array function over all parts of them, ``aim`` gives the
        probability to reach and the weight of each row of a part; ``n`` is how often a row stands."""
        mean = total(lambda r: _aim_sums(r, aim))
        p = np.clip(mean[0] / max(mean[1], 1), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        for _ in range(TREES):
            self.trees.append(self._tree(total, aim))
        return self

    def _tree(self, total: Callable, aim: Callable) -> list[tuple[int, int, float]]:
        leaf = lambda g, h: float(RATE * g / (h + 1.0))
        nodes: list[tuple[int, int, float]] = [(-1, 0, 0.0)] * (2 ** (DEPTH + 1) - 1)
        for level in range(DEPTH):
            # The closure holds its own copy of what is known so far.
            sums = total(lambda r, so_far=[*nodes], level=level: self._sums(r, aim, so_far, level)) * _UNIT
            for node, (g, h, n) in enumerate(sums, 2**level - 1):
                whole_g, whole_h = g[0].sum(), h[0].sum()
                if level == 0:
                    nodes[0] = (-1, 0, leaf(whole_g, whole_h))
                if n[0].sum() < 10:
                    continue
                left_g, left_h = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
                right_g, right_h = whole_g - left_g, whole_h - left_h
                gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - whole_g**2 / (whole_h + 1)
                k, cut = np.unravel_index(gain.argmax(), gain.shape)
                if gain[k, cut] > 1e-6:
                    nodes[node] = (int(k), int(cut), nodes[node][2])
                    nodes[2 * node + 1] = (-1, 0, leaf(left_g[k, cut], left_h[k, cut]))
                    nodes[2 * node + 2] = (-1, 0, leaf(right_g[k, cut], right_h[k, cut]))
        return nodes

    def _sums(self, rows: dict, aim: Callable, tree: list[tuple[int, int, float]], level: int) -> np.ndarray:
        """Slopes, bends and numbers of rows in units by (node of the level, which of the three, feature, bin)."""
        bins, n = rows["bins"], rows["n"]
        y, weight = aim(rows)
        p = self.of_bins(bins)
        values = [np.rint(v * weight / _UNIT) * n for v in (y - p, p * (1 - p), np.ones(len(n)))]
        node = self._places(tree, bins, level) - (2**level - 1)
        here = node >= 0
        out = np.zeros((2**level, 3, bins.shape[1], BINS))
        for k in range(bins.shape[1]):
            at = node[here] * BINS + bins[here, k]
            for j, v in enumerate(values):
                out[:, j, k] = np.bincount(at, v[here], 2**level * BINS).reshape(-1, BINS)
        return out

    def _places(self, tree: list[tuple[int, int, float]], bins: np.ndarray, depth: int) -> np.ndarray:
        split, cut, _ = (np.array(c) for c in zip(*tree, strict=True))
        node = np.zeros(len(bins), int)
        for _ in range(depth):
            inner = split[node] >= 0
            right = bins[np.arange(len(bins)), np.maximum(split[node], 0)] > cut[node]
            node = np.where(inner, 2 * node + 1 + right, node)
        return node

    def of_bins(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.base)
        for tree in self.trees:
            total += np.array([v for _, _, v in tree])[self._places(tree, bins, DEPTH)]
        return 1 / (1 + np.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.of_bins(self._bins(x))


def _edges(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Where the bins of a feature begin, from its sorted values and their weights."""
    upto = np.cumsum(weights)
    at = np.searchsorted(upto, np.linspace(0, upto[-1], BINS + 1)[1:-1])
    return np.unique(values[np.minimum(at, len(values) - 1)])


def _aim_sums(rows: dict, aim: Callable) -> np.ndarray:
    y, weight = aim(rows)
    return np.array([(np.rint(v / _UNIT) * rows["n"]).sum() for v in (y * weight, weight)])


@dataclass
class Model:
    trees: Trees
    #: Of each kind, the probability from which a span is added; above 1 if none is.
    thresholds: tuple[float, ...] = (2.0,) * len(KINDS)


#: Labels of examples: personal data, something else, not known, and plain numbers and words.
_YES, _NO, _OPEN, _PLAIN = 1, 0, 2, 3


def examples(text: str) -> list[tuple[tuple[int, int, int], int]]:
    """Spans of a text that teach something, with their labels."""
    base = strict(text)
    free = lambda s, e: all(e <= b[0] or b[2] <= s for b in base)
    out = [(s, _YES) for s in base]
    wide = [s for s in proposed(text) if free(s[0], s[2])]
    for s in wide:
        kind, span = KINDS[s[1]], text[s[0] : s[2]]
        out.append((s, _NO if refuted(kind, span) or fails(kind, span) else _OPEN))
    held = lambda s, e: not free(s, e) or any(s < w[2] and w[0] < e for w in wide)
    for pattern, most, kinds in ((_NUMBER, _PLAIN_NUMBERS, (1, 2, 3)), (_NEAR, _PLAIN_WORDS, (0,))):
        found = [m.span() for m in pattern.finditer(text)]
        # Spread over the text, so its begin is not all there is of it.
        for s, e in found[:: max(1, -(-len(found) // most))]:
            if not held(s, e):
                out.append(((s, kinds[s % len(kinds)], e), _PLAIN))
    return out


def _prior() -> tuple[np.ndarray, np.ndarray]:
    """Contexts that every model has seen: a cue or another word before a span of each kind, or before a failed card."""
    x, y = [], []
    for k, kind in enumerate(KINDS):
        for label, words in ((_YES, _CUES[kind]), (_NO, _OTHER)):
            for text in sorted(f"{w}{mark}" for w in words for mark in (" ", ": ")):
                x.append([float(v) for v in features(text, len(text), k, len(text))])
                y.append(label)
                if kind == "card":
                    x.append([float(v) for v in features(f"{text}4111111111111112", len(text), k, len(text) + 16)])
                    y.append(_NO)
    return np.array(x), np.array(y)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features and label of each example of each document."""
    for batch in few_rows(batches):
        docs, starts, x, y = [], [], [], []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for span, label in examples(text or ""):
                docs.append(doc)
                starts.append(span[0])
                x.append([float(v) for v in features(text, *span)])
                y.append(label)
        columns = [pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "x", "y"])


_EXAMPLE = "doc_id long, start long, x array<double>, y int"


def sampled(docs: DataFrame, sample: int) -> DataFrame:
    """Examples (doc_id, start, x, y) of ``sample`` documents, ``EXAMPLES * sample`` at most: whichever hashes choose.

    For a look at examples; ``fit`` uses all of them.
    """
    ids = docs.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(stored(ids)), "doc_id", "left_semi")
    found = rows.mapInArrow(_examples, _EXAMPLE)
    return found.orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start", "x").limit(EXAMPLES * sample)


def fit(docs: DataFrame) -> Model:
    """Trees and thresholds from all documents with a doc_id.

    Three quarters of the documents, by a hash of doc_id, train the trees and the others set the thresholds. Open
    candidates of a kind with fewer than ``EVIDENCE`` base spans teach nothing, and its threshold is ``LIKELY``: the
    words that tell of it and the contexts of other kinds decide. A table without any base span has such a model too.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    apart = (F.crc32(F.col("doc_id").cast("string")) % 4 == 3).alias("apart")
    found = stored(rows.mapInArrow(_examples, _EXAMPLE).select(F.col("x")[0].cast("int").alias("kind"), "y", apart, "x"))
    before, label = _prior()
    # Each feature has a bounded number of values, so their counts fit the driver whatever the table.
    values = found.select("kind", "y", "apart", F.posexplode("x").alias("feature", "value"))
    counts = values.groupBy("kind", "y", "apart", "feature", "value").count().toArrow()
    kind, y, apart, feature, value, n = (counts.column(k).to_numpy() for k in range(6))
    size, many = before.shape[1], len(label)
    kind = np.concatenate([kind, np.repeat(before[:, 0].astype(int), size)])
    y, apart = np.concatenate([y, np.repeat(label, size)]), np.concatenate([apart.astype(bool), np.zeros(many * size, bool)])
    feature, value = np.concatenate([feature, np.tile(np.arange(size), many)]), np.concatenate([value, before.ravel()])
    n = np.concatenate([n, np.ones(many * size, np.int64)])
    once = feature == 0
    number = lambda label: np.bincount(kind[once & (y == label) & ~apart], n[once & (y == label) & ~apart], len(KINDS))
    told, plain = number(_YES), number(_PLAIN)
    # Plain numbers and words are no candidates: more of them than half the base spans would outvote these everywhere.
    weights = np.zeros((len(KINDS), 4))
    weights[:, [_YES, _NO]] = 1.0
    weights[:, _OPEN] = told >= EVIDENCE
    weights[:, _PLAIN] = np.minimum(1.0, told // 2 / np.maximum(plain, 1))
    weight = weights[kind, y] * ~apart * n
    trees = Trees()
    for k in range(size):
        at = (feature == k) & (weight > 0)
        each, place = np.unique(value[at], return_inverse=True)
        trees.edges.append(_edges(each, np.bincount(place, weight[at])))
    prior = _rows(trees._bins(before), before[:, 0].astype(int), label, np.zeros(many, bool), np.ones(many, np.int64))
    coded = found.mapInArrow(_coded(trees), "code long, kind int, y int, apart boolean")
    return _model(trees, weights, prior, stored(coded.groupBy("code", "kind", "y", "apart").agg(F.count("*").alias("n"))))


def _rows(bins: np.ndarray, kind: np.ndarray, y: np.ndarray, apart: np.ndarray, n: np.ndarray) -> dict:
    return {"bins": bins, "kind": kind, "y": y, "apart": apart, "n": n}


def _coded(trees: Trees):
    """The bins of each example in one number, four bits for each feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            bins = trees._bins(x) if len(x) else np.zeros((0, len(trees.edges)), np.int64)
            code = (bins << 4 * np.arange(len(trees.edges))).sum(1)
            columns = [pa.array(code, pa.int64()), *(batch.column(c) for c in ("kind", "y", "apart"))]
            yield pa.RecordBatch.from_arrays(columns, ["code", "kind", "y", "apart"])

    return run


def _decoded(table: pa.Table | pa.RecordBatch, size: int) -> dict:
    code, kind, y, n = (np.asarray(table.column(c)) for c in ("code", "kind", "y", "n"))
    return _rows((code[:, None] >> 4 * np.arange(size)) & 15, kind, y, np.asarray(table.column("apart")).astype(bool), n)


def _total(prior: dict, coded: DataFrame) -> Callable:
    """A function that adds up an array function over the prior and all stored rows."""
    size = prior["bins"].shape[1]
    if coded.count() <= FEW:
        held = _decoded(coded.toArrow(), size)
        return lambda f: f(prior) + f(held)

    def total(f: Callable) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = None
            for batch in batches:
                if batch.num_rows:
                    part = f(_decoded(batch, size))
                    parts = part if parts is None else parts + part
            if parts is not None:
                yield pa.RecordBatch.from_arrays([pa.array([parts.tobytes()], pa.binary())], ["sums"])

        first = f(prior)
        found = coded.mapInArrow(run, "sums binary").toArrow().column("sums").to_pylist()
        return first + sum(np.frombuffer(x).reshape(first.shape) for x in found)

    return total


def _model(trees: Trees, weights: np.ndarray, prior: dict, coded: DataFrame) -> Model:
    total = _total(prior, coded)
    weigh = lambda r: np.where(r["apart"], 0.0, weights[r["kind"], r["y"]])
    labelled = Trees(trees.edges).grown(total, lambda r: ((r["y"] == _YES).astype(float), weigh(r)))
    # The share of personal data that base spans are, as their mean probability to be labelled.
    seen = total(lambda r: _base_sums(labelled, r))
    held, fitted = (seen[k, :, 0] * _UNIT / np.maximum(seen[k, :, 1], 1) for k in (1, 0))
    share = np.clip(np.where(seen[1, :, 1] > 0, held, fitted), 0.01, 0.99)

    def aim(rows: dict) -> tuple[np.ndarray, np.ndarray]:
        g = np.clip(labelled.of_bins(rows["bins"]), 1e-6, 1 - 1e-6)
        c = share[rows["kind"]]
        soft = np.clip((1 - c) / c * g / (1 - g), 0, 1)
        return np.where(rows["y"] == _OPEN, soft, rows["y"] == _YES), weigh(rows)

    trees.grown(total, aim)
    return Model(trees, tuple(map(_threshold, total(lambda r: _base_levels(trees, r)))))


def _base_sums(trees: Trees, rows: dict) -> np.ndarray:
    """Of base spans, the sum of their probabilities in units and their number, by (apart, kind)."""
    out = np.zeros((2, len(KINDS), 2))
    at = rows["y"] == _YES
    p = np.rint(trees.of_bins(rows["bins"][at]) / _UNIT)
    np.add.at(out, (rows["apart"][at].astype(int), rows["kind"][at]), np.stack([p, np.ones(len(p))], 1) * rows["n"][at, None])
    return out


def _base_levels(trees: Trees, rows: dict) -> np.ndarray:
    """The number of base spans kept apart by kind and probability, in steps of 1 / ``_STEPS``."""
    out = np.zeros((len(KINDS), _STEPS))
    at = (rows["y"] == _YES) & rows["apart"]
    step = np.minimum(trees.of_bins(rows["bins"][at]) * _STEPS, _STEPS - 1).astype(int)
    np.add.at(out, (rows["kind"][at], step), rows["n"][at])
    return out


def _threshold(levels: np.ndarray) -> float:
    """The highest step, ``LIKELY`` at most, that a share of ``RECALL`` of the base spans reaches."""
    n = levels.sum()
    if n < EVIDENCE:
        return LIKELY
    step = int(np.searchsorted(np.cumsum(levels), int((1 - RECALL) * n), "right"))
    return min(LIKELY, max(step, 0.5) / _STEPS)


def spans(model: Model, texts: list[str]) -> tuple[list[list[tuple[int, int, int]]], list[list[tuple[int, int, int]]]]:
    """Base spans of each text, and all spans: base ones and those the trees add."""
    base = [strict(t) for t in texts]
    every = [list(b) for b in base]
    if not model.trees.trees:
        return base, every
    todo = []
    for k, text in enumerate(texts):
        wide = [s for s in proposed(text) if not refuted(KINDS[s[1]], text[s[0] : s[2]])]
        todo += [(k, s) for s in wide if all(s[2] <= b[0] or b[2] <= s[0] for b in base[k])]
    if todo:
        p = model.trees.predict(np.array([[float(v) for v in features(texts[k], *s)] for k, s in todo]))
        for i in sorted(range(len(todo)), key=lambda i: (-p[i], todo[i])):
            k, s = todo[i]
            if p[i] >= model.thresholds[s[1]] and all(s[2] <= b[0] or b[2] <= s[0] for b in every[k]):
                every[k].append(s)
    return base, [sorted(x) for x in every]


def written(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def _detect(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            base, every = spans(model, [t or "" for t in batch.column("text").to_pylist()])
            counts = [pa.array([sum(s[1] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
            sha = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base], pa.string())
            columns = [batch.column("doc_id"), *counts, sha, pa.array([written(x) for x in every], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return run


def detected(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) to (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), a row for each row.

    Counts and digest are of the base spans, ``spans`` lists all. Places are code points. A null text is empty. Null
    and repeated doc_ids pass through; null ones teach nothing. Other columns are not read. No rows give no rows.
    """
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_detect(fit(docs)), f"doc_id long, {counts}, base_sha256 string, spans string")


def redacted(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in capitals; of overlapping spans the first stands for all."""
    out, at = [], 0
    for s, k, e in found:
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _redact(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            texts = batch.column("text").to_pylist()
            every = spans(model, [t or "" for t in texts])[1]
            new = [t if t is None else redacted(t, x) for t, x in zip(texts, every, strict=True)]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(new, pa.string()))

    return run


def without_pii(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with the spans in ``text`` redacted; a null text stays null, other columns pass through."""
    return docs.mapInArrow(_redact(model), docs.schema)
