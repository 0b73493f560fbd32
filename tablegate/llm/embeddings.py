"""Near-duplicate embeddings: exact cosine links, with binary codes to leave out most pairs.

A vector is turned by a seeded random rotation and coded by the signs of what comes out. With the code goes its
correction factor, the inner product of the vector and its code. Dividing the product of one vector's code and another
vector by that factor estimates their cosine without bias, with an error that the factor bounds. Only pairs whose
upper bound reaches the threshold are computed again, in double precision.

Vectors of a label are dealt to blocks by the nearest of a bounded set of pivots. Two blocks meet only if the ranges
of their angles to all pivots allow an angle below the threshold, so tight clusters do not meet the rest. Equal
vectors of a label are one entry with a count. Counts and links leave a pair of blocks, never pairs of a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.frames import components, split_by, stored
from tablegate.llm.signature_tree import Groups

THRESHOLD = 0.93
SEED = 11
#: Entries of a block, entries of a label's sample for one pivot, and pivots at most.
BLOCK = 1024
PER_PIVOT = 4096
PIVOTS = 64
#: Standard errors of the estimate in the confidence bound; a miss has odds below one in 10**11.
DEVIATIONS = 7.0
_PAIRS = 1 << 15


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vector: list | None) -> np.ndarray | None:
    """A vector of length one; None if it is null, empty, zero, or has null or non-finite components."""
    if vector is None or not len(vector) or any(x is None for x in vector):
        return None
    x = np.asarray(vector, np.float64)
    if not np.isfinite(x).all() or not (top := np.abs(x).max()):
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs of the rotated vectors as packed bits, and their correction factors."""
    turned = vectors @ rotation(vectors.shape[1]).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / np.sqrt(vectors.shape[1])


def upper_bounds(bits: np.ndarray, factors: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For coded rows and whole vectors, a bound that the cosine of each pair does not pass.

    The smaller of two bounds: the unbiased estimate with its confidence, and the one that always holds, as the angle
    between two vectors is at least the angle to the code less the angle from the code to its own vector.
    """
    dim = others.shape[1]
    signs = (np.unpackbits(bits, axis=1, count=dim).astype(np.float64) * 2 - 1) / np.sqrt(dim)
    near = np.clip(signs @ (others @ rotation(dim).T).T, -1, 1)
    c = np.clip(factors, 1e-9, 1)[:, None]
    off = np.sqrt(1 - c * c)
    estimate = near / c + DEVIATIONS * off / (c * np.sqrt(max(1, dim - 1)))
    certain = np.where(near >= c, 1.0, c * near + off * np.sqrt(1 - near * near))
    return np.minimum(estimate, certain)


def links(
    x: np.ndarray, bits: np.ndarray, factors: np.ndarray, y: np.ndarray, threshold: float, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of x, row of y) with a cosine of at least ``threshold``; each pair once if both are the same rows."""
    for k in range(0, len(x), 256):
        may = upper_bounds(bits[k : k + 256], factors[k : k + 256], y) >= threshold - 1e-9
        if same:
            may &= np.arange(len(y))[None, :] > np.arange(k, k + len(may))[:, None]
        left, right = np.nonzero(may)
        for s in range(0, len(left), _PAIRS):
            i, j = left[s : s + _PAIRS] + k, right[s : s + _PAIRS]
            hit = np.einsum("ij,ij->i", x[i], y[j]) >= threshold
            yield i[hit], j[hit]


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the name of its label and vector, null if it links with nothing, and its vector of length one."""
    for batch in batches:
        names, units = [], []
        labels, ids = batch.column("label").to_pylist(), batch.column("vec_id").to_pylist()
        for label, row, vector in zip(labels, ids, batch.column("embedding").to_pylist(), strict=True):
            x = None if label is None or row is None else unit(vector)
            raw = None if x is None else repr((str(label), len(x))).encode() + x.tobytes()
            names.append(None if raw is None else hashlib.blake2b(raw, digest_size=16).hexdigest())
            units.append(None if x is None else x.tobytes())
        made = [pa.array(names, pa.string()), pa.array(units, pa.binary())]
        columns = [batch.column("vec_id"), batch.column("label"), *made]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "name", "x"])


def _angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ pivots.T, -1, 1))


def _coded(pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("x").to_pylist()
            dims = [len(b) // 8 for b in raw]
            cells, all_bits, factors, angles = [0] * len(raw), [b""] * len(raw), [0.0] * len(raw), [[]] * len(raw)
            for dim in set(dims):
                at = [i for i, n in enumerate(dims) if n == dim]
                x = np.stack([np.frombuffer(raw[i]) for i in at])
                bits, factor = codes(x)
                angle = _angles(x, pivots[dim]) if dim in pivots else np.zeros((len(x), 1))
                for k, i in enumerate(at):
                    cells[i], all_bits[i], factors[i] = int(angle[k].argmin()), bits[k].tobytes(), float(factor[k])
                    angles[i] = angle[k].tolist()
            columns = [
                pa.array(cells, pa.int32()),
                pa.array(dims, pa.int32()),
                pa.array(all_bits, pa.binary()),
                pa.array(factors, pa.float64()),
                pa.array(angles, pa.list_(pa.float64())),
            ]
            names = [*batch.schema.names, "cell", "dim", "bits", "factor", "angles"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)

    return run


def _compare(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in split_by(batches, ["left", "right"]):
            side = np.array(part.column("side"))
            names, copies = part.column("name").to_pylist(), np.array(part.column("copies"))
            raw = part.column("x").to_pylist()
            x = np.stack([np.frombuffer(b) for b in raw])
            bits = np.stack([np.frombuffer(b, np.uint8) for b in part.column("bits").to_pylist()])
            factors = np.array(part.column("factor"))
            same = part.column("left")[0].as_py() == part.column("right")[0].as_py()
            a = np.arange(len(x)) if same else np.flatnonzero(side == 0)
            b = a if same else np.flatnonzero(side == 1)
            counts, groups = np.zeros(len(x), np.int64), Groups(len(x))
            if len(a) and len(b):
                for i, j in links(x[a], bits[a], factors[a], x[b], threshold, same):
                    i, j = a[i], b[j]
                    np.add.at(counts, i, copies[j])
                    np.add.at(counts, j, copies[i])
                    # One link for each row and a sweep over the rest: pairs in one group already are skipped.
                    for u, v in zip(i.tolist(), j.tolist(), strict=True):
                        if groups.up[u] != groups.up[v]:
                            groups.join(u, v)
            roots = [names[groups.find(k)] for k in range(len(x))]
            keep = [k for k in range(len(x)) if counts[k]]
            columns = [
                pa.array([names[k] for k in keep], pa.string()),
                pa.array([roots[k] for k in keep], pa.string()),
                pa.array([int(counts[k]) for k in keep], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "links"])

    return run


def _pivots(entries: DataFrame, count: int) -> dict[int, np.ndarray]:
    """For each of the 16 smallest lengths of vectors, at most PIVOTS of them, those with the smallest names.

    Vectors of other lengths all lie in one cell, which costs time and no link.
    """
    sizes = entries.select((F.length("x") / 8).cast("int").alias("dim")).distinct().orderBy("dim").limit(16)
    wanted = max(1, min(PIVOTS, count // PER_PIVOT))
    out = {}
    for (dim,) in sizes.collect():
        rows = entries.where(F.length("x") == 8 * dim).orderBy("name").select("x").limit(wanted).collect()
        out[dim] = np.stack([np.frombuffer(r[0]) for r in rows])
    return out


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, embedding, label) to (vec_id, n_links, component_id, kept), a row for each row.

    Vectors of one label link if their cosine is at least ``threshold``. ``n_links`` counts the other rows a row links
    with directly, ``component_id`` is the smallest vec_id reachable by links, ``kept`` whether that is the row's own.
    Null labels and vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor
    do vectors of different lengths. A row with a null vec_id links with nothing, has a null component and is not kept.
    Repeated rows are copies that link with each other. Other columns are not read. An empty table gives no rows.
    """
    kind = vectors.schema["label"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    rows = stored(rows.mapInArrow(_entries, f"vec_id long, label {kind}, name string, x binary"))
    entries = stored(
        rows.where("name is not null")
        .groupBy("name")
        .agg(
            F.first("label").alias("label"),
            F.first("x").alias("x"),
            F.count("*").alias("copies"),
            F.min("vec_id").alias("least"),
        )
    )
    pivots = _pivots(entries, entries.count())
    schema = f"name string, label {kind}, x binary, copies long"
    schema += ", cell int, dim int, bits binary, factor double, angles array<double>"
    coded = stored(entries.select("name", "label", "x", "copies").mapInArrow(_coded(pivots), schema))
    sizes = coded.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("name"), "parts")
    blocks = coded.join(sizes, ["label", "dim", "cell"]).withColumn("block", F.concat_ws("/", "dim", "cell", part))
    pairs = _meeting(blocks, threshold)
    ways = [F.struct(F.col(c).alias("block"), F.lit(k).alias("side")) for k, c in enumerate(("left", "right"))]
    sides = pairs.withColumn("way", F.explode(F.array(*ways)))
    sides = sides.where("left <> right or way.side = 0").select("label", "left", "right", "way.*")
    dealt = blocks.select("label", "block", "name", "x", "bits", "factor", "copies").join(sides, ["label", "block"])
    whole = [F.concat_ws("|", F.col("label").cast("string"), c).alias(c) for c in ("left", "right")]
    dealt = dealt.select(*whole, "side", "name", "x", "bits", "factor", "copies")
    found = dealt.repartition("left", "right").sortWithinPartitions("left", "right", "name")
    found = stored(found.mapInArrow(_compare(threshold), "a string, b string, links long"))
    roots = components(found.select("a", "b").distinct()).withColumnsRenamed({"node": "name", "root": "group"})
    counted = found.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "name")
    named = entries.select("name", "copies", "least").join(roots, "name", "left").withColumn("group", F.coalesce("group", "name"))
    first = named.groupBy("group").agg(F.min("least").alias("component"))
    named = named.join(first, "group").join(counted, "name", "left")
    named = named.select("name", "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    out = rows.select("vec_id", "name").join(named, "name", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _meeting(blocks: DataFrame, threshold: float) -> DataFrame:
    """Pairs of blocks of a label that may hold a link, each once: (label, left, right)."""
    ranges = blocks.select("label", "dim", "block", F.posexplode("angles").alias("pivot", "angle"))
    ranges = ranges.groupBy("label", "dim", "block", "pivot").agg(F.min("angle").alias("low"), F.max("angle").alias("high"))
    ranges = ranges.groupBy("label", "dim", "block").agg(F.sort_array(F.collect_list(F.struct("pivot", "low", "high"))).alias("r"))
    ranges = stored(ranges)
    other = ranges.select("label", "dim", F.col("block").alias("right"), F.col("r").alias("s"))
    reach = float(np.arccos(threshold)) + 1e-9
    gap = lambda p, q: F.greatest(p["low"] - q["high"], q["low"] - p["high"])
    meet = F.forall(F.zip_with("r", "s", gap), lambda g: g <= reach)
    pairs = ranges.withColumnRenamed("block", "left").join(other, ["label", "dim"]).where("left <= right")
    return pairs.where(meet).select("label", "left", "right")
