"""Open-set language detection, measured for languages left out of training."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from lakestrata.plans import open_set
from lakestrata.plans.language import UNKNOWN, detect_language


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text", "lang").where("text is not null and lang is not null")


def _held(key="doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


@pytest.mark.parametrize("left_out", ["fr", "de"])
def test_a_language_never_taught_is_unknown(spark, docs, left_out, tmp_dir):
    detector = open_set.train_open_set(docs.where(~_held() & (F.col("lang") != left_out)))
    assert left_out not in detector.seen and len(detector.seen) == 3
    got = open_set.detect_open_set(docs, detector, details=True).cache()
    rows = got.select("doc_id", "lang", "code", _held().alias("held"), F.length("text").alias("n")).collect()
    assert len(rows) == docs.count()
    strange = [r for r in rows if r.lang == left_out and r.n >= 100]
    assert sum(r.code == UNKNOWN for r in strange) >= 0.95 * len(strange) > 20
    known = [r for r in rows if r.lang != left_out and r.held]
    assert sum(r.code == r.lang for r in known) >= 0.93 * len(known) > 50
    # the closed detector takes nearly all of them for one of its own
    closed = detect_language(docs.where(F.col("lang") == left_out), detector.model)
    assert closed.where(F.col("code") == UNKNOWN).count() < 0.5 * len(strange)
    open_set.save_open_set(detector, spark, f"{tmp_dir}/d")
    again = open_set.detect_open_set(docs, open_set.load_open_set(spark, f"{tmp_dir}/d"))
    assert {r.doc_id: r.code for r in again.collect()} == {r.doc_id: r.code for r in rows}


def test_other_scripts_and_odd_texts(spark, docs):
    detector = open_set.train_open_set(docs)
    texts = [None, "", "123 !?", "これは日本語の文章です。" * 20, "это русский текст " * 20, "qqq zzz xxx " * 30]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    assert [r.code for r in open_set.detect_open_set(rows, detector).orderBy("id").collect()] == [UNKNOWN] * len(texts)
    assert open_set.detect_open_set(rows.limit(0), detector).count() == 0
