"""From raw documents to token ids: language, near duplicates, personal data, mixture, encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``. All but the last return the columns of
``docs``; each result is written and read again before the next stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.llm import bpe, jaccard, language, mixing, pii
from tablegate.llm.frames import find_package, short_batches, stored, with_ids

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
_SEED = 23


def _carried(columns: list[str]) -> Column:
    """The columns as one value, so that none meets a column that an operator adds."""
    return F.struct(*columns).alias("row")


def _unpacked(rows: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The carried columns, or what is given for them, in the order of ``columns``."""
    return rows.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those that are ``und`` go. A null ``lang`` becomes the predicted one.

    If no document has a language to learn from, all with a letter stay. A text that is null or has no letter is
    ``und``; an empty table stays empty. Other columns pass through, whatever their names.
    """
    short_batches(spark)
    model = language.fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    rows = docs.select(_carried([c for c in docs.columns if c != "text"]), "text")
    found = language.identified(rows, model).where(F.col("lang_pred") != language.UNKNOWN)
    lang = F.coalesce(F.col("row").getField("lang"), F.col("lang_pred"))
    return _unpacked(found, docs.columns, text=F.col("text"), lang=lang)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates; a repeated row stays once.

    Documents without words and rows with a null doc_id are in no group and stay.
    """
    short_batches(spark)
    groups = stored(jaccard.jaccard_groups(docs))
    # Rows of one doc_id with other texts are told apart by their texts below.
    repeated = stored(groups.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id"))
    kept = stored(groups.where("doc_id = component_id").select("doc_id").distinct())
    rows = with_ids(docs, kept, "doc_id").select(docs.columns).union(docs.where("doc_id IS NULL"))
    if repeated.isEmpty():
        return rows
    several = rows.join(repeated, "doc_id", "left_semi")
    alone = rows.join(repeated, "doc_id", "left_anti")
    return alone.select(docs.columns).union(_one_row_each(several.select(docs.columns)))


def _one_row_each(rows: DataFrame) -> DataFrame:
    """Of rows with repeated doc_ids, one for each group: equal rows are merged, and the rest compared under new ids."""
    named = stored(rows.distinct().select(_carried(rows.columns), "text", F.xxhash64(*rows.columns).alias("key")))
    groups = jaccard.jaccard_groups(named.select(F.col("key").alias("doc_id"), "text"))
    least = groups.where("doc_id = component_id").select(F.col("doc_id").alias("key")).distinct()
    return _unpacked(named.join(least, "key", "left_semi"), rows.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows the text.

    All documents stay; a null text stays null with its ``n_chars``, an empty one has none. Other columns pass through.
    """
    short_batches(spark)
    rows = docs.select(_carried([c for c in docs.columns if c != "text"]), "text")
    found = pii.without_pii(rows, pii.fit(docs))
    size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    n_chars = F.coalesce(size, F.col("row").getField("n_chars"))
    return _unpacked(found, docs.columns, text=F.col("text"), n_chars=n_chars)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, from zero to two times.

    A document that is taken in part is rounded up or down by a seeded draw, so sources keep their targets on average.
    Documents without words stay once. An empty table stays empty. Other columns pass through, whatever their names.
    """
    # Null ids and sources are joined as texts that no other has; rows that agree in all three share what they take.
    key = F.to_json(F.struct("doc_id", "source", "size"), {"ignoreNullFields": "false"}).alias("key")
    taken = mixing.mixed(docs).groupBy(key, "doc_id", "size").agg((F.sum("taken") / F.count("*")).alias("taken"))
    draw = mixing.draw(_SEED, F.col("doc_id")) / F.lit(float(16**15))
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + draw)).otherwise(1).cast("int")
    times = stored(taken.select("key", times.alias("times")).where("times > 0"))
    rows = docs.select(_carried(docs.columns), "doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
    rows = with_ids(rows.select("row", key), times, "key")
    return _unpacked(rows.select("row", F.explode(F.sequence(F.lit(1), "times"))), docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding them gives the text back. A null text has no ids."""
    short_batches(spark)
    return bpe.encoded(docs.select("doc_id", "lang", "source", "text"), VOCABULARY)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("personal_data", without_personal_data),
    ("mixture", mixed_sources),
    ("tokens", token_ids),
]

#: SQL can express neither the models nor the merges; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    find_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
