"""

All queries run on the given tables. Vectors and token lists come out in long form, one row
per value, so that both engines compare exact scalars.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import widevec as wv
from widevec.plans.owner_mail import COLUMNS
from widevec.sources.scratch import scratch_path

try:
    import corpus_pipeline
    from widevec.llm import queries as llm
except ModuleNotFoundError as missing:
    # The training-text operators are an optional part; anything else that is missing is an error.
    if missing.name != "corpus_pipeline" and not missing.name.startswith("widevec.llm"):
        raise
    llm = corpus_pipeline = None
from widevec.testing import check_model

STATES = ("BUILDING", "MACHINERY")
MAX_TOKENS = 128
WIDTH = 8

# A word-level vocabulary: pad, unknown, then frequent words of the test texts.
WORDS = (
    "the of | de and to in a la der is that en for it on was die with que le be The as des und by are"
    " this et er at les re th an he from es ha or ed Property Owner: Owners: Mailing Address:"
    " BUILDING MACHINERY N1 N2 N3"
).split()
VOCABULARY = {"[PAD]": 0, "[UNK]": 1} | {word: i + 2 for i, word in enumerate(WORDS)}
DEFINITION = json.dumps(
    {
        "version": "1.0",
        "truncation": None,
        "padding": None,
        "added_tokens": [],
        "normalizer": None,
        "pre_tokenizer": {"type": "WhitespaceSplit"},
        "post_processor": None,
        "decoder": None,
        "model": {"type": "WordLevel", "vocab": VOCABULARY, "unk_token": "[UNK]"},
    }
)


# ---------------------------------------------------------------- inputs


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def owners(spark, sf_dir):
    """Customers seen as owner rows, with nulls and empty names put in by rule."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("gid"),
        F.when(key % 7 != 0, F.col("c_name")).alias("o1"),
        F.when(key % 3 == 1, F.lit("")).when(key % 3 == 2, F.col("c_mktsegment")).alias("o2"),
        F.when(key % 5 != 0, F.concat(F.lit("N"), F.col("c_nationkey"))).alias("addr"),
        F.col("c_mktsegment").alias("st"),
    )


def owner_texts(spark, sf_dir):
    return wv.owner_mail(owners(spark, sf_dir), "gid", "o1", "o2", "addr", "st", STATES)


def owner_config(**changes):
    values = dict(
        embedding_dim=WIDTH,
        max_tokens=MAX_TOKENS,
        batch_size=256,
        input_columns=COLUMNS,
        tokenizer_type="byt5",
    )
    return wv.EmbedConfig(**(values | changes))


def byte_model(spark, **options):
    pooling = options.pop("pooling", "mean")
    return wv.model_from_bytes(spark, check_model(width=WIDTH, **options), pooling)


def word_model(spark):
    return wv.model_from_bytes(spark, check_model(vocabulary=len(VOCABULARY), width=WIDTH))


def words(spark):
    return wv.SubwordTokenizer(wv.ship_bytes(spark, DEFINITION.encode()))


def owner_sql(source):
    """The stock projection as a user of the SQL source writes it, with ANSI operators only."""
    both = "coalesce(o1, '') || coalesce(', ' || nullif(o2, ''), '')"
    return f"""
        SELECT gid,
               coalesce(o1, '') AS raw_owner_name_1,
               'Property Owner: ' || coalesce(o2, '') AS context_owner_name_2,
               {both} AS raw_owner_names_concatenated,
               coalesce(addr, '') AS raw_address,
               'Property Owners: ' || {both} || ' | Property Mailing Address: '
                   || coalesce(addr, '') AS context_both
        FROM ({owner_rows_sql(source)}) AS owners
        WHERE st IN ('BUILDING', 'MACHINERY')"""


def owner_rows_sql(source):
    return f"""
        SELECT c_custkey AS gid,
               CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS o1,
               CASE WHEN c_custkey % 3 = 1 THEN '' WHEN c_custkey % 3 = 2 THEN c_mktsegment END AS o2,
               CASE WHEN c_custkey % 5 <> 0 THEN 'N' || c_nationkey END AS addr,
               c_mktsegment AS st
        FROM {source}"""


# ---------------------------------------------------------------- long forms


def long_vectors(df, names):
    """``gid``, ``name``, ``dim``, ``value``: one row per vector component."""
    named = F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("vector")) for n in names))
    return (
        df.select("gid", F.inline(named))
        .select("gid", "name", F.posexplode("vector"))
        .select("gid", "name", F.col("pos").alias("dim"), F.col("col").alias("value"))
    )


def long_ids(df, *keys):
    return df.select(*keys, F.posexplode("ids").alias("pos", "id"))


def long_tokens(df, *keys):
    zipped = F.arrays_zip("ids", "attention_mask", "token_type_ids")
    return df.select(*keys, F.posexplode(zipped).alias("pos", "token")).select(
        *keys,
        "pos",
        F.col("token.ids").alias("id"),
        F.col("token.attention_mask").alias("mask"),
        F.col("token.token_type_ids").alias("segment"),
    )


def id_sums(df, *keys):
    """Count, sum and position-weighted sum of the ids: they fix a whole list in three numbers."""
    add = lambda total, value: total + value
    weighted = F.transform("ids", lambda x, i: x.cast("long") * (i + 1))
    return df.select(
        *keys,
        F.size("ids").alias("tokens"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda total, x: total + x).alias("id_sum"),
        F.aggregate(weighted, F.lit(0).cast("long"), add).alias("weighted_sum"),
    )


# ---------------------------------------------------------------- queries: sources, projections


def scan_filter_in(spark, sf_dir):
    found = table(spark, sf_dir, "documents").filter(wv.is_in("lang", ("de", "fr")))
    return found.select("doc_id", "lang", "source", "n_chars")


def lake_table(spark, sf_dir):
    """A table of the session's catalog under its three-part name: only its entry is made here."""
    schema = "lake_" + hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
    name = f"spark_catalog.{schema}.documents"
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS spark_catalog.{schema}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{sf_dir}/documents.parquet'")
    return wv.read_source(spark, owner_config(source_table=name)).select("doc_id", "text", "lang")


def parquet_path(spark, sf_dir):
    cfg = owner_config(source_path=f"{sf_dir}/conversations.parquet")
    return wv.read_source(spark, cfg).select("conv_id", "turn", "text")


def sql_source(spark, sf_dir):
    source = f"parquet.`{sf_dir}/documents.parquet`"
    query = f"SELECT doc_id, upper(lang) AS lang, n_chars * 2 AS twice FROM {source} WHERE n_chars > 100"
    return wv.read_source(spark, owner_config(source_query=query))


def text_batch(spark, sf_dir):
    return wv.text_batch(table(spark, sf_dir, "benchmark"))


def text_batch_nulls(spark, sf_dir):
    key = F.col("c_custkey")
    found = owners(spark, sf_dir).withColumnRenamed("gid", "c_custkey")
    return wv.text_batch(found.select(F.when(key % 4 != 0, key.cast("int")), "o2", "addr", "c_custkey"))


def null_default(spark, sf_dir):
    return owners(spark, sf_dir).select("gid", wv.text_or_empty("o1").alias("text"))


def non_empty_test(spark, sf_dir):
    return owners(spark, sf_dir).select("gid", wv.non_empty("o2").alias("has_text"))


def labelled_text(spark, sf_dir):
    return owners(spark, sf_dir).select("gid", wv.labelled("Property Owner: ", "o2").alias("text"))


def joined_text(spark, sf_dir):
    return owners(spark, sf_dir).select("gid", wv.joined("o1", "o2", ", ").alias("text"))


def context_text(spark, sf_dir):
    both = wv.joined("o1", "o2", " & ")
    text = wv.context("Owners: ", both, " | Address: ", F.col("addr"))
    return owners(spark, sf_dir).select("gid", text.alias("text"))


def perspectives(spark, sf_dir):
    return owner_texts(spark, sf_dir)


def perspectives_sql(spark, sf_dir):
    source = f"parquet.`{sf_dir}/customer.parquet`"
    return wv.read_source(spark, owner_config(source_query=owner_sql(source)))


def bind_columns(spark, sf_dir):
    key = F.col("c_custkey")
    rows = owners(spark, sf_dir).withColumnRenamed("gid", "c_custkey")
    rows = rows.withColumn("row_id", F.when(key % 4 != 0, key.cast("int")))
    return wv.bind_columns(rows, owner_config(id_column="row_id", input_columns=("o2", "addr", "o1")))


def pack_slots(spark, sf_dir):
    return wv.pack_slots(owner_texts(spark, sf_dir), COLUMNS).withColumnRenamed("column", "name")


# ---------------------------------------------------------------- queries: tokens


def byt5_encode(spark, sf_dir):
    found = wv.encode(table(spark, sf_dir, "conversations"), "text", wv.ByteTokenizer())
    return long_ids(found, "conv_id", "turn")


def byt5_encode_documents(spark, sf_dir):
    return id_sums(wv.encode(table(spark, sf_dir, "documents"), "text", wv.ByteTokenizer()), "doc_id")


def byt5_encode_pages(spark, sf_dir):
    return id_sums(wv.encode(table(spark, sf_dir, "pages"), "html", wv.ByteTokenizer()), "page_id")


def byt5_encode_then_filter(spark, sf_dir):
    """Filters written after the tokens: that on another column reaches the scan."""
    found = wv.encode(table(spark, sf_dir, "documents"), "text", wv.ByteTokenizer(), pushdown=True)
    return id_sums(found.filter((F.col("lang") == "de") & (F.size("ids") > 500)), "doc_id")


def pool_then_filter(spark, sf_dir):
    found = wv.pool(hidden_states(spark, sf_dir), "hidden", "mask", "mean", pushdown=True)
    return long_vectors(found.filter(F.col("gid") % 2 == 0), ["pooled"])


def byt5_encode_expr(spark, sf_dir):
    ids = wv.byte_ids_expr(F.col("text")).alias("ids")
    return long_ids(table(spark, sf_dir, "conversations").select("conv_id", "turn", ids), "conv_id", "turn")


def byt5_fixed(spark, sf_dir):
    found = wv.tokenize(table(spark, sf_dir, "documents"), "text", wv.ByteTokenizer(), MAX_TOKENS)
    return long_tokens(found, "doc_id")


def byt5_fixed_expr(spark, sf_dir):
    ids = wv.byte_ids_expr(F.col("text"), MAX_TOKENS).alias("ids")
    return long_ids(table(spark, sf_dir, "documents").select("doc_id", ids), "doc_id")


def byt5_stats(spark, sf_dir):
    """A fixed length of 4,096: the cut is the feature, and longer texts lose their rest."""
    found = wv.tokenize(table(spark, sf_dir, "documents"), "text", wv.ByteTokenizer(), 4096)
    real = F.aggregate("attention_mask", F.lit(0), lambda total, m: total + m)
    return id_sums(found, "doc_id", F.size("attention_mask").alias("mask_size"), real.alias("real"))


def byt5_perspectives(spark, sf_dir):
    slots = wv.pack_slots(owner_texts(spark, sf_dir), COLUMNS)
    return long_tokens(wv.tokenize(slots, "text", wv.ByteTokenizer(), 32), "gid", "v")


def byt5_decode(spark, sf_dir):
    found = wv.encode(table(spark, sf_dir, "documents"), "text", wv.ByteTokenizer())
    return wv.detokenize(found.select("doc_id", "ids"), "ids", wv.ByteTokenizer()).select("doc_id", "text")


def token_type_ids(spark, sf_dir):
    found = wv.tokenize(table(spark, sf_dir, "benchmark"), "text", wv.ByteTokenizer(), MAX_TOKENS)
    return found.select("item_id", F.posexplode("token_type_ids").alias("pos", "segment"))


def subword_encode(spark, sf_dir):
    return long_ids(wv.encode(table(spark, sf_dir, "documents"), "text", words(spark)), "doc_id")


def subword_fixed(spark, sf_dir):
    return long_tokens(wv.tokenize(table(spark, sf_dir, "documents"), "text", words(spark), 64), "doc_id")


def subword_perspectives(spark, sf_dir):
    """Rows with empty texts, which have no word at all: an all-zero mask."""
    slots = wv.pack_slots(owner_texts(spark, sf_dir), COLUMNS)
    return long_tokens(wv.tokenize(slots, "text", words(spark), 6), "gid", "v")


def subword_decode(spark, sf_dir):
    tokenizer = words(spark)
    found = wv.encode(table(spark, sf_dir, "documents"), "text", tokenizer).select("doc_id", "ids")
    return wv.detokenize(found, "ids", tokenizer).select("doc_id", "text")


def tokenizer_choice(spark, sf_dir):
    """``"byt5"`` is bytes, any other name the definition in the vocabulary file."""
    path = scratch_path(spark, "definition")
    spark.createDataFrame([(DEFINITION,)], "definition string").coalesce(1).write.text(path)
    rows = table(spark, sf_dir, "conversations")
    found = []
    for kind in ("byt5", "anything"):
        cfg = owner_config(tokenizer_type=kind, vocab_path=f"{path}/*.txt")
        ids = wv.encode(rows, "text", wv.make_tokenizer(spark, cfg))
        found.append(id_sums(ids, F.lit(kind).alias("kind"), "conv_id", "turn"))
    return found[0].unionByName(found[1])


# ---------------------------------------------------------------- queries: pooling


def hidden_states(spark, sf_dir):
    """Stored vectors read as eight tokens of eight dimensions, with 0 to 8 of them real."""
    rows = F.sequence(F.lit(0), F.lit(7))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("gid"),
        F.transform(rows, lambda t: F.slice("embedding", t * 8 + 1, F.lit(8))).alias("hidden"),
        F.transform(rows, lambda t: (t < F.col("vec_id") % 9).cast("int")).alias("mask"),
    )


def pool_with(mode, use_python=True):
    def query(spark, sf_dir):
        found = wv.pool(hidden_states(spark, sf_dir), "hidden", "mask", mode, use_python)
        return long_vectors(found, ["pooled"])

    return query


def pool_mode(spark, sf_dir):
    """Each set of flags with the mode it resolves to, and the vectors that mode gives."""
    flags = {
        "cls_and_mean": {"pooling_mode_cls_token": True, "pooling_mode_mean_tokens": True},
        "mean_and_max": {"pooling_mode_mean_tokens": True, "pooling_mode_max_tokens": True},
        "max_only": {"pooling_mode_cls_token": False, "pooling_mode_max_tokens": True},
        "none": {},
    }
    rows = hidden_states(spark, sf_dir)
    found = None
    for name, chosen in flags.items():
        pooled = wv.pool(rows, "hidden", "mask", wv.pooling_mode(chosen)).withColumnRenamed("pooled", name)
        part = long_vectors(pooled, [name])
        found = part if found is None else found.unionByName(part)
    return found


# ---------------------------------------------------------------- queries: embedding


def embed_wide(spark, sf_dir):
    found = wv.embed(owner_texts(spark, sf_dir), owner_config(), model=byte_model(spark))
    return long_vectors(found, COLUMNS)


def embed_subset(spark, sf_dir):
    names = [COLUMNS[3], COLUMNS[1]]
    found = wv.embed(owner_texts(spark, sf_dir), owner_config(), columns=names, model=byte_model(spark))
    return long_vectors(found, names)


def embed_batches(spark, sf_dir):
    """Another batch size and partitioning, and no sharing of repeated texts: the same vectors."""
    cfg = owner_config(batch_size=7, partitions=5)
    found = wv.embed(owner_texts(spark, sf_dir), cfg, model=byte_model(spark), reuse_repeats=False)
    return long_vectors(found, COLUMNS)


def embed_documents(spark, sf_dir):
    """Whole documents at the stock batch size: calls are bounded by their tokens."""
    cfg = owner_config(input_columns=("text",), id_column="doc_id", max_tokens=2**20, trim_padding=True)
    found = wv.embed(table(spark, sf_dir, "documents"), cfg, model=byte_model(spark))
    return long_vectors(found, ["text"])


def embed_whole_documents(spark, sf_dir):
    """Every document to its last byte; short ones are not padded to the length of the longest."""
    cfg = owner_config(
        input_columns=("text",), id_column="doc_id", max_tokens=2**20, batch_size=16, trim_padding=True
    )
    return long_vectors(wv.embed(table(spark, sf_dir, "documents"), cfg, model=byte_model(spark)), ["text"])


def embed_trimmed(spark, sf_dir):
    """Shorter padding, the same vectors."""
    found = wv.embed(owner_texts(spark, sf_dir), owner_config(trim_padding=True), model=byte_model(spark))
    return long_vectors(found, COLUMNS)


def embed_long_texts(spark, sf_dir):
    """Room for 4,096 tokens, with the padding that brings."""
    rows = table(spark, sf_dir, "conversations").withColumn("gid", F.col("conv_id") * 1000 + F.col("turn"))
    cfg = owner_config(input_columns=("text",), max_tokens=4096, batch_size=64)
    return long_vectors(wv.embed(rows, cfg, model=byte_model(spark)), ["text"])


def embed_hidden(mode):
    """A model without pooling of its own, which also asks for segment ids in int64."""

    def query(spark, sf_dir):
        model = byte_model(spark, pooled=False, segment_ids=True, ids_type=7, pooling=mode)
        found = wv.embed(owner_texts(spark, sf_dir), owner_config(), model=model)
        return long_vectors(found, COLUMNS)

    return query


def embed_subword(spark, sf_dir):
    found = wv.embed(
        owner_texts(spark, sf_dir), owner_config(), model=word_model(spark), tokenizer=words(spark)
    )
    return long_vectors(found, COLUMNS)


def vector_width(spark, sf_dir):
    cfg = owner_config(input_columns=("text",), id_column="item_id")
    found = wv.embed(table(spark, sf_dir, "benchmark"), cfg, model=byte_model(spark))
    return found.select("gid", F.size("text").alias("width"))


# ---------------------------------------------------------------- queries: runs


def sink_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "vectors")
    wv.write_vectors(wv.embed(owner_texts(spark, sf_dir), owner_config(), model=byte_model(spark)), path)
    return long_vectors(spark.read.parquet(path), COLUMNS)


def run_written(spark, sf_dir):
    cfg = owner_config(
        source_query=owner_sql(f"parquet.`{sf_dir}/customer.parquet`"),
        enable_s3_output=True,
        s3_output_path=scratch_path(spark, "vectors"),
    )
    return long_vectors(wv.run(spark, cfg, model=byte_model(spark)).df, COLUMNS)


def output_switch(spark, sf_dir):
    cfg = owner_config(
        source_query=owner_sql(f"parquet.`{sf_dir}/customer.parquet`"),
        enable_s3_output=False,
        s3_output_path="/this/path/is/not/written",
    )
    return long_vectors(wv.run(spark, cfg, model=byte_model(spark)).df, COLUMNS)


def run_json(spark, sf_dir):
    """The job as a file describes it, read back from the shared folder."""
    job = {
        "source_query": owner_sql(f"parquet.`{sf_dir}/customer.parquet`"),
        "input_columns": list(COLUMNS),
        "tokenizer_type": "byt5",
        "vocab_path": "",
        "model_path": "given with the call",
        "embedding_dim": WIDTH,
        "max_tokens": MAX_TOKENS,
        "batch_size": 256,
        "enable_s3_output": True,
        "s3_output_path": scratch_path(spark, "vectors"),
    }
    path = scratch_path(spark, "job.json")
    spark.createDataFrame([(json.dumps(job),)], "value string").coalesce(1).write.text(path)
    cfg = wv.EmbedConfig.from_json(path, spark)
    return long_vectors(wv.run(spark, cfg, model=byte_model(spark)).df, COLUMNS)


def run_in_parts(spark, sf_dir):
    """The same rows from four parts, each with a commit of its own."""
    cfg = owner_config(
        source_query=owner_sql(f"parquet.`{sf_dir}/customer.parquet`"),
        enable_s3_output=True,
        s3_output_path=scratch_path(spark, "vectors"),
        output_parts=4,
    )
    return long_vectors(wv.run(spark, cfg, model=byte_model(spark)).df, COLUMNS)


def run_metrics(spark, sf_dir):
    cfg = owner_config(enable_s3_output=True, s3_output_path=scratch_path(spark, "vectors"))
    done = wv.run(spark, cfg, owner_texts(spark, sf_dir), model=byte_model(spark)).metrics
    counts = (done.source_rows, done.rows_processed, done.rows_written, done.sequences)
    names = "source_rows long, rows_processed long, rows_written long, sequences long"
    return spark.createDataFrame([counts], names)


def entry(spark: SparkSession) -> DataFrame:
    """The flagship: filter, project to five texts, tokenize, embed, one wide row per input row."""
    wv.ship_package(spark)
    sf_dir = "/root/testdata/sf0.001"
    return wv.embed(owner_texts(spark, sf_dir), owner_config(), model=byte_model(spark))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {
        query.__name__: query
        for query in (
            scan_filter_in,
            lake_table,
            parquet_path,
            sql_source,
            text_batch,
            text_batch_nulls,
            null_default,
            non_empty_test,
            labelled_text,
            joined_text,
            context_text,
            perspectives,
            perspectives_sql,
            bind_columns,
            pack_slots,
            byt5_encode,
            byt5_encode_documents,
            byt5_encode_pages,
            byt5_encode_then_filter,
            pool_then_filter,
            byt5_encode_expr,
            byt5_fixed,
            byt5_fixed_expr,
            byt5_stats,
            byt5_perspectives,
            byt5_decode,
            token_type_ids,
            subword_encode,
            subword_fixed,
            subword_perspectives,
            subword_decode,
            tokenizer_choice,
            pool_mode,
            embed_wide,
            embed_subset,
            embed_batches,
            embed_documents,
            embed_whole_documents,
            embed_trimmed,
            embed_long_texts,
            embed_subword,
            vector_width,
            sink_roundtrip,
            run_written,
            output_switch,
            run_metrics,
            run_json,
            run_in_parts,
        )
    }
    for mode in ("mean", "cls", "max"):
        named[f"pool_{mode}"] = pool_with(mode)
        named[f"pool_{mode}_expr"] = pool_with(mode, use_python=False)
        named[f"embed_hidden_{mode}"] = embed_hidden(mode)
    if llm:
        named |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return {name: _with_package(query) for name, query in named.items()}


def _with_package(query):
    def run(spark, sf_dir):
        wv.ship_package(spark)
        return query(spark, sf_dir)

    return run


# ---------------------------------------------------------------- the same in DuckDB


def byte_ids_sql(rows, keys, text, max_len=None):
    """Real byte tokens of ``rows``: keys, pos from 0, id; the end mark included."""
    size = f"octet_length(encode({text}))"
    if max_len is not None:
        size = f"least({size}, {max_len - 1})"
    return f"""
        SELECT {keys}, pos, CASE WHEN pos < n THEN CAST('0x' || pairs[pos + 1] AS INTEGER) + 3 ELSE 1 END AS id
        FROM (SELECT *, unnest(range(n + 1)) AS pos
              FROM (SELECT {keys}, CAST({size} AS BIGINT) AS n,
                           regexp_extract_all(hex(encode({text})), '..') AS pairs
                    FROM {rows}) AS sized) AS placed"""


def flat_byte_ids_sql(rows, keys, text):
    """As above for whole long texts: the bytes are unnested once instead of indexed."""
    return f"""
        SELECT {keys}, pos, id FROM (
            SELECT {keys}, unnest(range(len(ids))) AS pos, unnest(ids) AS id
            FROM (SELECT {keys},
                         list_append(list_transform(regexp_extract_all(hex(encode({text})), '..'),
                                                    lambda x: CAST('0x' || x AS INTEGER) + 3), 1) AS ids
                  FROM {rows}) AS listed) AS placed"""


def word_ids_sql(rows, keys, text):
    values = ", ".join(f"('{word}', {number})" for word, number in VOCABULARY.items())
    return f"""
        SELECT {keys}, pos, word, coalesce(number, 1) AS id
        FROM (SELECT {keys}, unnest(range(len(parts))) AS pos, unnest(parts) AS word
              FROM (SELECT {keys},
                           list_filter(regexp_split_to_array({text}, '[ \\n]+'), lambda x: x <> '') AS parts
                    FROM {rows}) AS split) AS placed
        LEFT JOIN (VALUES {values}) AS vocabulary(known, number) ON word = known"""


def fixed_sql(rows, keys, ids, max_len):
    joined_keys = " AND ".join(f"places.{key.strip()} = found.{key.strip()}" for key in keys.split(","))
    places = ", ".join(f"places.{key.strip()}" for key in keys.split(","))
    return f"""
        SELECT {places}, CAST(p AS INTEGER) AS pos, CAST(coalesce(id, 0) AS INTEGER) AS id,
               CAST(CASE WHEN id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS mask, CAST(0 AS INTEGER) AS segment
        FROM (SELECT {keys}, unnest(range({max_len})) AS p FROM {rows}) AS places
        LEFT JOIN ({ids}) AS found ON {joined_keys} AND p = found.pos"""


def plain_ids_sql(keys, ids):
    return f"SELECT {keys}, CAST(pos AS INTEGER) AS pos, CAST(id AS INTEGER) AS id FROM ({ids}) AS found"


def id_sums_sql(keys, ids, extra=""):
    return f"""
        SELECT {keys}, {extra} CAST(count(*) AS INTEGER) AS tokens, CAST(sum(id) AS BIGINT) AS id_sum,
               CAST(sum(id * (pos + 1)) AS BIGINT) AS weighted_sum
        FROM ({ids}) AS found GROUP BY {keys}"""


def slots_sql():
    parts = " UNION ALL ".join(
        f"SELECT gid, CAST({v} AS INTEGER) AS v, '{name}' AS name, {name} AS text FROM texts"
        for v, name in enumerate(COLUMNS)
    )
    return f"(WITH texts AS ({owner_sql('customer')}) {parts})"


def mean_sql(slots, ids):
    """Mean of the check model's token vectors, zero where a text has no token."""
    return f"""
        SELECT slots.gid, slots.name, CAST(d AS INTEGER) AS dim,
               CAST(coalesce(total / (64.0::DOUBLE * n), 0) AS FLOAT) AS value
        FROM (SELECT gid, name, unnest(range({WIDTH})) AS d FROM {slots} AS s) AS slots
        LEFT JOIN (SELECT gid, name, w, CAST(sum((id * (2 * w + 1)) % 64) AS DOUBLE) AS total, count(*) AS n
                   FROM ({ids}) AS tokens, (SELECT unnest(range({WIDTH})) AS w) AS dims
                   GROUP BY gid, name, w) AS sums
        ON slots.gid = sums.gid AND slots.name = sums.name AND d = w"""


def owner_mean_sql(columns=COLUMNS):
    kept = ", ".join(f"'{name}'" for name in columns)
    slots = f"(SELECT * FROM {slots_sql()} AS every_slot WHERE name IN ({kept}))"
    return mean_sql(slots, byte_ids_sql(f"{slots} AS chosen", "gid, name", "text", MAX_TOKENS))


def owner_token_sql(choice):
    """CLS or max over the check model's token vectors; a byte text always has a token."""
    slots = f"{slots_sql()} AS chosen"
    return f"""
        SELECT gid, name, CAST(d AS INTEGER) AS dim, CAST({choice} / 64.0::DOUBLE AS FLOAT) AS value
        FROM (SELECT *, (id * (2 * d + 1)) % 64 AS h
              FROM ({byte_ids_sql(slots, "gid, name", "text", MAX_TOKENS)}) AS tokens,
                   (SELECT unnest(range({WIDTH})) AS d) AS dims) AS vectors
        GROUP BY gid, name, d"""


def pool_sql(mode, name="pooled"):
    shown = "CASE WHEN t < vec_id % 9 THEN x ELSE CAST(-1e9 AS DOUBLE) END"
    value = {
        "mean": "coalesce(sum(x) FILTER (WHERE t < vec_id % 9), 0) / greatest(vec_id % 9, CAST(1e-9 AS DOUBLE))",
        "cls": "max(x) FILTER (WHERE t = 0)",
        "max": f"max({shown})",
    }[mode]
    return f"""
        SELECT vec_id AS gid, '{name}' AS name, CAST(d AS INTEGER) AS dim, CAST({value} AS FLOAT) AS value
        FROM (SELECT vec_id, i // 8 AS t, i % 8 AS d, CAST(embedding[i + 1] AS DOUBLE) AS x
              FROM (SELECT *, unnest(range(64)) AS i FROM embeddings) AS places) AS vectors
        GROUP BY vec_id, d"""


def owner_expression_sql(expression, name):
    return f"SELECT gid, {expression} AS {name} FROM ({owner_rows_sql('customer')}) AS owners"


def oracle_sql() -> dict[str, str]:
    byte_documents = flat_byte_ids_sql("documents", "doc_id", "text")
    german = flat_byte_ids_sql("(SELECT * FROM documents WHERE lang = 'de') AS german", "doc_id", "text")
    byte_turns = flat_byte_ids_sql("conversations", "conv_id, turn", "text")
    word_documents = word_ids_sql("documents", "doc_id", "text")
    cut_documents = byte_ids_sql("documents", "doc_id", "text", MAX_TOKENS)
    slots = f"{slots_sql()} AS slots"
    has_two = "o2 IS NOT NULL AND o2 <> ''"
    slot_keys = "gid, name"
    turns = "(SELECT conv_id * 1000 + turn AS gid, 'text' AS name, text FROM conversations)"
    documents = "(SELECT doc_id AS gid, 'text' AS name, text FROM documents)"
    numbered = (
        "SELECT CASE WHEN gid % 4 <> 0 THEN gid END AS row_id, *"
        f" FROM ({owner_rows_sql('customer')}) AS owners"
    )
    long_cut = byte_ids_sql("documents", "doc_id", "text", 4096)
    expected = {
        "scan_filter_in": "SELECT doc_id, lang, source, n_chars FROM documents WHERE lang IN ('de', 'fr')",
        "lake_table": "SELECT doc_id, text, lang FROM documents",
        "parquet_path": "SELECT conv_id, turn, text FROM conversations",
        "sql_source": "SELECT doc_id, upper(lang) AS lang, n_chars * 2 AS twice FROM documents WHERE n_chars > 100",
        "text_batch": "SELECT coalesce(item_id, 0) AS gid, coalesce(text, '') AS text FROM benchmark",
        "text_batch_nulls": (
            f"SELECT coalesce(row_id, 0) AS gid, coalesce(o2, '') AS text FROM ({numbered}) AS numbered"
        ),
        "null_default": owner_expression_sql("coalesce(o1, '')", "text"),
        "non_empty_test": owner_expression_sql(f"({has_two})", "has_text"),
        "labelled_text": owner_expression_sql(
            "'Property Owner: ' || coalesce(o2, '')", "text"
        ),
        "joined_text": owner_expression_sql(
            "coalesce(o1, '') || coalesce(', ' || nullif(o2, ''), '')", "text"
        ),
        "context_text": owner_expression_sql(
            "'Owners: ' || coalesce(o1, '') || coalesce(' & ' || nullif(o2, ''), '')"
            " || ' | Address: ' || coalesce(addr, '')",
            "text",
        ),
        "perspectives": owner_sql("customer"),
        "perspectives_sql": owner_sql("customer"),
        "bind_columns": (
            "SELECT coalesce(row_id, 0) AS gid, coalesce(o2, '') AS o2, coalesce(addr, '') AS addr,"
            f" coalesce(o1, '') AS o1 FROM ({numbered}) AS numbered"
        ),
        "pack_slots": f"SELECT gid, v, name, text FROM {slots}",
        "byt5_encode": plain_ids_sql("conv_id, turn", byte_turns),
        "byt5_encode_documents": id_sums_sql("doc_id", byte_documents),
        "byt5_encode_pages": id_sums_sql("page_id", flat_byte_ids_sql("pages", "page_id", "html")),
        "byt5_encode_then_filter": (
            "SELECT * FROM (" + id_sums_sql("doc_id", german) + ") AS sums WHERE tokens > 500"
        ),
        "pool_then_filter": "SELECT * FROM (" + pool_sql("mean") + ") AS pooled WHERE gid % 2 = 0",
        "byt5_encode_expr": plain_ids_sql("conv_id, turn", byte_turns),
        "byt5_fixed": fixed_sql("documents", "doc_id", cut_documents, MAX_TOKENS),
        "byt5_fixed_expr": (
            "SELECT doc_id, pos, id FROM ("
            + fixed_sql("documents", "doc_id", cut_documents, MAX_TOKENS)
            + ") AS found"
        ),
        # Padding adds zeros only, so it shows in the number of tokens alone.
        "byt5_stats": f"""
            SELECT doc_id, CAST(4096 AS INTEGER) AS mask_size, tokens AS real,
                   CAST(4096 AS INTEGER) AS tokens, id_sum, weighted_sum
            FROM ({id_sums_sql("doc_id", long_cut)}) AS sums""",
        "byt5_perspectives": fixed_sql(slots, "gid, v", byte_ids_sql(slots, "gid, v", "text", 32), 32),
        "byt5_decode": "SELECT doc_id, text FROM documents",
        "token_type_ids": f"""
            SELECT item_id, CAST(pos AS INTEGER) AS pos, CAST(0 AS INTEGER) AS segment
            FROM (SELECT item_id, unnest(range({MAX_TOKENS})) AS pos FROM benchmark) AS places""",
        "subword_encode": plain_ids_sql("doc_id", word_documents),
        "subword_fixed": fixed_sql("documents", "doc_id", word_documents, 64),
        "subword_perspectives": fixed_sql(slots, "gid, v", word_ids_sql(slots, "gid, v", "text"), 6),
        "subword_decode": f"""
            SELECT doc_id,
                   coalesce(string_agg(CASE WHEN id = 1 THEN '[UNK]' ELSE word END, ' ' ORDER BY pos), '') AS text
            FROM ({word_documents}) AS found GROUP BY doc_id""",
        "tokenizer_choice": (
            f"SELECT 'byt5' AS kind, * FROM ({id_sums_sql('conv_id, turn', byte_turns)}) AS bytes UNION ALL"
            " SELECT 'anything' AS kind, * FROM ("
            + id_sums_sql("conv_id, turn", word_ids_sql("conversations", "conv_id, turn", "text"))
            + ") AS words"
        ),
        "pool_mean": pool_sql("mean"),
        "pool_cls": pool_sql("cls"),
        "pool_max": pool_sql("max"),
        "pool_mean_expr": pool_sql("mean"),
        "pool_cls_expr": pool_sql("cls"),
        "pool_max_expr": pool_sql("max"),
        "pool_mode": " UNION ALL ".join(
            f"SELECT * FROM ({pool_sql(mode, name)}) AS {name}"
            for name, mode in (
                ("cls_and_mean", "cls"),
                ("mean_and_max", "mean"),
                ("max_only", "max"),
                ("none", "mean"),
            )
        ),
        "embed_wide": owner_mean_sql(),
        "embed_subset": owner_mean_sql((COLUMNS[3], COLUMNS[1])),
        "embed_batches": owner_mean_sql(),
        "embed_documents": mean_sql(
            documents, flat_byte_ids_sql(f"{documents} AS d", slot_keys, "text")
        ),
        "embed_whole_documents": mean_sql(
            documents, flat_byte_ids_sql(f"{documents} AS d", slot_keys, "text")
        ),
        "embed_trimmed": owner_mean_sql(),
        "embed_long_texts": mean_sql(turns, byte_ids_sql(f"{turns} AS t", slot_keys, "text", 4096)),
        "embed_hidden_mean": owner_mean_sql(),
        "embed_hidden_cls": owner_token_sql("max(h) FILTER (WHERE pos = 0)"),
        "embed_hidden_max": owner_token_sql("max(h)"),
        "embed_subword": mean_sql(slots_sql(), word_ids_sql(slots, slot_keys, "text")),
        "vector_width": f"SELECT item_id AS gid, CAST({WIDTH} AS INTEGER) AS width FROM benchmark",
        "sink_roundtrip": owner_mean_sql(),
        "run_written": owner_mean_sql(),
        "run_json": owner_mean_sql(),
        "run_in_parts": owner_mean_sql(),
        "output_switch": owner_mean_sql(),
        "run_metrics": f"""
            SELECT count(*) AS source_rows, count(*) AS rows_processed, count(*) AS rows_written,
                   CAST(5 * count(*) AS BIGINT) AS sequences
            FROM ({owner_sql("customer")}) AS texts""",
    }
    if llm:
        expected |= llm.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            expected["pipeline"] = corpus_pipeline.ORACLE_SQL
    return expected
