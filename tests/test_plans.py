"""What Spark makes of the operators: the properties that decide how they scale."""

import re

import pytest
from pyspark.sql import functions as F

import widevec as wv

STATES = ["BUILDING", "MACHINERY"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def texts(spark, sf):
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    return wv.owner_mail(customer, "c_custkey", "c_name", "c_mktsegment", "c_name", "c_mktsegment", STATES)


def test_flagship_is_one_narrow_stage(texts, config, model):
    found = plan(wv.embed(texts, config(input_columns=texts.columns[1:]), model=model))
    assert "Exchange" not in found
    assert found.count("MapInArrow") == 1
    assert "PushedFilters: [In(c_mktsegment, [BUILDING,MACHINERY])]" in found
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_mktsegment:string>" in found


def test_subset_prunes_the_scan(spark, sf, config, model):
    customer = spark.read.parquet(f"{sf}/customer.parquet")
    cfg = config(id_column="c_custkey", input_columns=("c_name", "c_mktsegment"))
    found = plan(wv.embed(customer, cfg, columns=["c_name"], model=model))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in found


def test_partitions_is_the_only_shuffle(texts, config, model):
    found = plan(wv.embed(texts, config(input_columns=texts.columns[1:]), partitions=6, model=model))
    assert found.count("Exchange") == 1 and "REPARTITION_BY_NUM" in found


def test_only_needed_bytes_reach_python(spark, sf, config, model):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    found = plan(wv.embed(documents, config(id_column="doc_id", input_columns=("text",)), model=model))
    assert re.search(r"MapInArrow.*\n.*Project \[.*substring\(cast\(.*text", found)


@pytest.mark.parametrize(
    "use",
    [
        lambda df: df.select("doc_id", F.posexplode("ids")),
        lambda df: df.filter(F.size("ids") == 16),
        lambda df: df.select("doc_id", "ids", "attention_mask", "token_type_ids"),
    ],
)
def test_tokens_are_made_once(spark, sf, use):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    found = plan(use(wv.tokenize(documents, "text", wv.ByteTokenizer(), 16)))
    assert found.count("ArrowEvalPython") == 1 and "Exchange" not in found


def test_unused_tokens_are_not_made(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    found = plan(wv.tokenize(documents, "text", wv.ByteTokenizer(), 16).select("doc_id", "token_type_ids"))
    assert "ArrowEvalPython" not in found
    assert "ReadSchema: struct<doc_id:bigint>" in found


def test_expressions_stay_in_the_jvm(spark, sf, texts):
    for df in (texts, wv.pack_slots(texts, texts.columns[1:])):
        found = plan(df)
        assert "Exchange" not in found and "Python" not in found and "Arrow" not in found
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    assert "Python" not in plan(documents.select(wv.byte_ids_expr(F.col("text"), 16)))


def test_filters_pass_the_long_form_and_text_batch(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    found = plan(wv.text_batch(documents.filter(wv.is_in("lang", ["de"]))))
    assert "PushedFilters: [In(lang" in found or "PushedFilters: [IsNotNull(lang), EqualTo(lang,de)]" in found
