"""The pipeline's stages against what they should do to small tables."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tablegate.llm import frames, jaccard, mixing, pii

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1000, None, None, None, None), (1001, " \n", "en", "s", 2), (1002, "12 34", "en", "s", 5)]
    rows += [(1003, "a b", None, None, 3), (1003, "c d", "en", None, 3)]
    more = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = spark.read.parquet(f"{SF}/documents.parquet")
    return df.union(more).union(df.limit(2)).cache()


def texts(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_language_stage_drops_only_texts_without_a_language(spark, docs):
    out = cp.known_language(spark, docs, SF)
    assert out.columns == docs.columns
    want = {k: n for k, n in texts(docs).items() if any(c.isalpha() for c in k[1] or "")}
    assert texts(out) == want
    assert out.where("lang IS NULL").count() == 0
    assert cp.known_language(spark, docs.limit(0), SF).count() == 0


def test_one_document_of_each_group_stays(spark, docs):
    out = cp.one_of_each_group(spark, docs, SF)
    assert out.columns == docs.columns
    groups = jaccard.jaccard_groups(docs).collect()
    kept = texts(out)
    assert set(kept.values()) == {1}
    repeated = {d for d, n in Counter(r["doc_id"] for r in docs.collect()).items() if n > 1}
    plain = {r["doc_id"] for r in groups} - repeated
    assert {d for d, _ in kept} & plain == {r["doc_id"] for r in groups if r["doc_id"] == r["component_id"]} & plain
    assert sum(d == 1003 for d, _ in kept) == 2


def test_personal_data_is_replaced(spark, docs):
    out = {r["doc_id"]: r for r in cp.without_personal_data(spark, docs, SF).collect()}
    found = 0
    for r in docs.collect():
        new = out[r["doc_id"]]
        spans = pii.strict(r["text"] or "")
        found += len(spans)
        if not spans and r["doc_id"] != 1003:
            assert new["text"] == r["text"] or "<" in new["text"]
        assert not pii.strict(new["text"] or "") and (new["text"] is None or new["n_chars"] == len(new["text"]))
    assert found > 5


def test_mixture_repeats_and_drops(spark, docs):
    first, again = (cp.mixed_sources(spark, docs.repartition(n), SF) for n in (3, 5))
    assert first.columns == docs.columns and texts(first) == texts(again)
    times, before = texts(first), texts(docs)
    sizes = {(r["doc_id"], r["text"]): len((r["text"] or "").split()) for r in docs.collect()}
    taken = {}
    for r in mixing.mixed(docs).collect():
        taken.setdefault(r["doc_id"], []).append((r["taken"], r["size"]))
    for key, n in before.items():
        whole = {int(t // s) for t, s in taken[key[0]] if s}
        if sizes[key] and key[0] < 1000 and n == 1:
            assert times[key] in {w + k for w in whole for k in (0, 1)}
        assert times[key] <= 2 * n


CLASHING = ("size", "key", "copy", "times", "score", "lang_pred", "r", "d", "n", "row", "taken", "least", "block")


@pytest.mark.parametrize("stage", [s for _, s in cp.STAGES[:-1]], ids=lambda f: f.__name__)
def test_clashing_columns_come_back_with_their_rows(spark, docs, stage):
    mine = docs.select("*", *[F.concat_ws("/", F.lit(c), "doc_id").alias(c) for c in CLASHING])
    out = stage(spark, mine, SF)
    assert out.columns == mine.columns
    plain = texts(stage(spark, docs, SF))
    rows = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == plain
    assert all(r[c] == (c if r["doc_id"] is None else f"{c}/{r['doc_id']}") for r in rows for c in CLASHING)


@pytest.mark.parametrize("stage", [s for _, s in cp.STAGES], ids=lambda f: f.__name__)
def test_empty_tables_stay_empty(spark, docs, stage):
    assert stage(spark, docs.limit(0), SF).count() == 0


@pytest.mark.parametrize("stage", [s for name, s in cp.STAGES if name != "mixture"], ids=lambda f: f.__name__)
def test_workers_get_a_bounded_part_of_a_task(spark, docs, stage):
    def sizes_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    long = spark.range(0, 3000, 1, 1).select("id", F.repeat(F.lit("x"), 4000).alias("text"))
    try:
        spark.conf.unset(limit)
        whole = Counter(map(str, stage(spark, docs, SF).collect()))
        sizes = [r["size"] for r in long.mapInArrow(sizes_of, "size long").collect()]
        assert sum(sizes) > 12_000_000 and max(sizes) < 1.01 * frames.BATCH_BYTES
        # A limit of the session's own stays, and no result depends on it.
        spark.conf.set(limit, "20000b")
        assert Counter(map(str, stage(spark, docs, SF).collect())) == whole
        assert spark.conf.get(limit) == "20000b"
    finally:
        spark.conf.unset(limit)


def test_whole_pipeline(spark):
    rows = cp.run(spark, SF).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert rows and all(r["round_trip"] and len(r["tokens"]) == r["n_tokens"] for r in rows)
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    clean = [r for r in rows if not pii.strict(text[r["doc_id"]])]
    assert all(r["tokens"] == library.encode(text[r["doc_id"]], add_special_tokens=False).ids for r in clean)
    assert len(cp.STAGES) == 5
