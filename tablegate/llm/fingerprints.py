"""Document fingerprints: one-permutation MinHash with packed low-order bits, in DataFrame functions only.

Every five-word shingle is hashed once. The top bits of a hash name its bin, and each of the 256 bins keeps its
smallest hash. An empty bin borrows from another bin, which a universal hash of the empty bin's number and the attempt
picks until one is filled (optimal densification). Eight low-order bits of each bin are stored, as hexadecimal
digits. The share of equal bins is corrected for bins that agree by chance.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.frames import let

WIDTH = 5
BINS = 256
BITS = 8
_TOP = 56
#: Attempts that are tried first with independent hashes; after that, all bins in an order of the empty bin's own.
_ATTEMPTS = 8
_WORD = r"[^\x20\x09-\x0D]+"


def _shingles(text: Column) -> Column:
    """Hashes of the five-word shingles; of fewer words the whole sequence, of none nothing."""

    def of_words(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - WIDTH)
        five = F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WIDTH)]))
        whole = F.when(F.size(h) > 0, F.array(F.xxhash64(h, F.lit(WIDTH)))).otherwise(F.array().cast("array<long>"))
        return F.when(F.size(h) >= WIDTH, five).otherwise(whole)

    words = F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))
    return let(F.transform(words, lambda w: F.xxhash64(w)), of_words)


def _bin(hash_: Column) -> Column:
    return F.shiftright(hash_, _TOP)


def _minima(hashes: Column) -> Column:
    """The smallest hash of each bin, null for an empty one: one sort with a last value added to every bin."""
    last = F.lit([(b << _TOP) + (1 << _TOP) - 1 for b in range(-BINS // 2, BINS // 2)])

    def first_of_bins(h: Column) -> Column:
        new = lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(h, i - 1)))
        empty = lambda x: x.bitwiseAND(F.lit((1 << _TOP) - 1)) == F.lit((1 << _TOP) - 1)
        return F.transform(F.filter(h, new), lambda x: F.when(~empty(x), x))

    return let(F.sort_array(F.concat(hashes, last)), first_of_bins)


def _bins(minima: Column) -> Column:
    """All bins: their minima, or what they borrow. At least one must be filled."""
    return let(minima, lambda m: F.transform(m, lambda x, b: F.coalesce(x, *_borrowed(m, b))))


def _borrowed(bins: Column, empty: Column) -> list[Column]:
    """What an empty bin may borrow, in order; the last entry looks at every bin there is."""
    picks = [F.get(bins, F.pmod(F.xxhash64(empty, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(_ATTEMPTS)]
    start = F.pmod(F.xxhash64(empty, F.lit(-1)), F.lit(BINS))
    step = F.pmod(F.xxhash64(empty, F.lit(-2)), F.lit(BINS // 2)) * 2 + 1
    place = lambda t: F.pmod(start + t * step, F.lit(BINS)).cast("int")
    found = lambda so_far, t: F.coalesce(so_far, F.get(bins, place(t)))
    return [*picks, F.aggregate(F.sequence(F.lit(0), F.lit(BINS - 1)), F.lit(None).cast("long"), found)]


def fingerprint(text: Column) -> Column:
    """The packed fingerprint of a text; empty for a text without words. Equal texts have equal fingerprints."""

    def packed(h: Column) -> Column:
        digits = F.transform(_bins(_minima(h)), lambda x: F.lpad(F.hex(x.bitwiseAND(2**BITS - 1)), BITS // 4, "0"))
        return F.when(F.size(h) > 0, F.lower(F.array_join(digits, ""))).otherwise("")

    return let(_shingles(text), packed)


def likeness(left: Column, right: Column) -> Column:
    """Estimate of the Jaccard similarity of two documents' shingles, from 0 to 1.

    Two bins that differ still agree in their stored bits once in 2**BITS times; that share is taken off. A text
    without words is like another such text and unlike all others.
    """
    width = BITS // 4
    at = F.sequence(F.lit(0), F.lit(BINS - 1))
    same = lambda n, i: n + (F.substr(left, i * width + 1, F.lit(width)) == F.substr(right, i * width + 1, F.lit(width))).cast("int")
    share = F.aggregate(at, F.lit(0), same) / BINS
    chance = 2.0**-BITS
    corrected = F.greatest(F.lit(0.0), (share - chance) / (1 - chance))
    return F.when(left == right, 1.0).when((left == "") | (right == ""), 0.0).otherwise(corrected)


def _longs(values: list[int]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<long>") if len(values) < 2 else F.lit(values).cast("array<long>")


def _bucket(key: Column, splits: list[int]) -> Column:
    """Number of the last split that is no larger than the key, found by groups and then in one group."""
    width = max(1, isqrt(len(splits)))
    upto = lambda values: F.size(F.filter(values, lambda s: s <= key))
    group = lambda g: g * width + upto(F.slice(_longs(splits), g * width + 1, width)) - 1
    return let(upto(_longs(splits[::width])) - 1, group)


def compared_with_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    ``docs`` (doc_id, text) to (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next), a row for each row. Documents follow each other by doc_id, then text; a null doc_id comes first, and
    after the last comes the first. The edited text has its last quarter of code points replaced by the first ones of
    the next document. A null text is empty. A document alone is its own next one. Other columns are not read.

    One shuffle: documents are dealt by ranges of doc_id, and the first ones of a range also go to the range before.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Null ids lie below all others.
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx(key, [i / n for i in range(n)], 100 * n), F.min(key)).first()
    splits = sorted({*(cuts[0] or []), *([] if cuts[1] is None else [cuts[1]])})
    rows = rows.withColumn("at", _bucket(key, splits))
    at, last = F.col("at"), len(splits) - 1
    # (bucket, order): its own, and for the first id of a bucket also the end of the bucket before.
    first = F.get(_longs(splits), at) == key
    guard = F.struct(F.when(at == 0, F.lit(last)).otherwise(at - 1).alias("bucket"), F.lit(1).alias("late"))
    own = F.struct(at.alias("bucket"), F.lit(0).alias("late"))
    copies = F.when(first, F.array(own, guard)).otherwise(F.array(own))
    dealt = rows.withColumn("copy", F.explode(copies)).select("doc_id", "text", "copy.*").repartition("bucket")
    dealt = dealt.withColumn("fingerprint", fingerprint(F.col("text")))
    line = Window.partitionBy("bucket").orderBy("late", "doc_id", "text")
    dealt = dealt.withColumn("next", F.lead("text").over(line)).withColumn("next_print", F.lead("fingerprint").over(line))
    dealt = dealt.where("late = 0").withColumn("n_chars", F.char_length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    kept = F.left("text", (F.col("n_chars") - quarter).cast("int"))
    edited = F.concat(kept, F.left(F.coalesce("next", "text"), quarter))
    out = dealt.withColumn("edited", edited).withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.coalesce("next_print", "fingerprint")).alias("near_next"),
    )
