import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import widevec as wv
from widevec.operators import embed as embedding
from widevec.operators.embed import distinct_texts, padded_lengths, window_rows
from widevec.testing import check_model

TEXTS = ["", "a", "Property: 123 Main St! 🏠", "é" * 30, "x" * 15, "x" * 16, "x" * 17, None]


@pytest.fixture(scope="module")
def rows(spark):
    pairs = [(i, TEXTS[i % len(TEXTS)], TEXTS[(i // 3) % len(TEXTS)]) for i in range(100)]
    return spark.createDataFrame(pairs, "gid long, a string, b string").repartition(3)


def vectors(df):
    return {row.gid: [list(v) for v in row[1:]] for row in df.collect()}


@pytest.fixture(scope="module")
def expected(rows):
    return {r.gid: [brute.byte_vector(r.a, 16), brute.byte_vector(r.b, 16)] for r in rows.collect()}


def test_vectors_and_schema(rows, expected, config, model):
    found = wv.embed(rows, config(), model=model)
    assert found.schema == wv.output_schema(config())
    assert vectors(found) == expected


@pytest.mark.parametrize("batch_size", [1, 7, 256])
@pytest.mark.parametrize("reuse", [True, False])
@pytest.mark.parametrize("trim", [True, False])
def test_batching_does_not_show(rows, expected, config, model, batch_size, reuse, trim):
    cfg = config(batch_size=batch_size, trim_padding=trim)
    assert vectors(wv.embed(rows, cfg, model=model, reuse_repeats=reuse)) == expected


@pytest.mark.parametrize("partitions", [1, 2, 13])
def test_partitioning_does_not_show(rows, expected, config, model, partitions):
    found = wv.embed(rows, config(), partitions=partitions, model=model)
    assert found.rdd.getNumPartitions() == partitions
    assert vectors(found) == expected


def test_column_subset_and_order(rows, expected, config, model):
    found = wv.embed(rows, config(), columns=["b"], model=model)
    assert found.columns == ["gid", "b"]
    assert vectors(found) == {gid: [both[1]] for gid, both in expected.items()}
    turned = wv.embed(rows, config(input_columns=("b", "a")), model=model)
    assert vectors(turned) == {gid: both[::-1] for gid, both in expected.items()}


def test_small_arrow_batches(spark, rows, expected, config, model):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert vectors(wv.embed(rows, config(), model=model)) == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_large_arrow_types(spark, rows, expected, config, model):
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    try:
        for reuse in (True, False):
            assert vectors(wv.embed(rows, config(), model=model, reuse_repeats=reuse)) == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "false")


def test_null_id_and_text(spark, config, model):
    one = spark.createDataFrame([(None, None, "x")], "gid long, a string, b string")
    (row,) = wv.embed(one, config(), model=model).collect()
    assert row.gid == 0
    assert list(row.a) == brute.byte_vector("", 16)


def test_no_rows(spark, config, model, tmp_path):
    none = spark.createDataFrame([], "gid long, a string, b string")
    found = wv.embed(none, config(), model=model)
    wv.write_vectors(found, str(tmp_path / "none"))
    back = spark.read.parquet(str(tmp_path / "none"))
    assert back.count() == 0 and back.columns == ["gid", "a", "b"]


def test_wrong_width_raises(rows, config, model):
    for trim in (True, False):
        with pytest.raises(Exception, match="expected"):
            wv.embed(rows, config(embedding_dim=9, trim_padding=trim), model=model).collect()


def test_missing_column_raises_before_the_job(rows, config, model):
    with pytest.raises(ValueError, match="missing"):
        wv.embed(rows.drop("b"), config(), model=model)


def test_broken_model_fails_the_job(spark, rows, config):
    with pytest.raises(Exception, match="INVALID_PROTOBUF|[Pp]rotobuf|Load model"):
        wv.embed(rows, config(), model=wv.model_from_bytes(spark, b"broken")).collect()


def test_model_file(spark, rows, expected, config, tmp_path):
    """Pooling flags come along."""
    path, flags = tmp_path / "model.onnx", tmp_path / "pooling.json"
    path.write_bytes(check_model(pooled=False))
    flags.write_text('{"pooling_mode_mean_tokens": true}')
    cfg = config(model_path=str(path), pooling_config_path=str(flags))
    assert vectors(wv.embed(rows, cfg)) == expected
    with pytest.raises(ValueError, match="model_path"):
        wv.embed(rows, config())


def test_two_models_in_one_session(spark, rows, expected, config, model):
    cls = wv.model_from_bytes(spark, check_model(pooled=False), "cls")
    for _ in range(2):
        assert vectors(wv.embed(rows, config(), model=model)) == expected
        first = wv.embed(rows, config(), model=cls).filter("gid = 1").first()
        table = ((np.array(brute.byte_ids("a"))[0] * (2 * np.arange(8) + 1)) % 64 / 64).tolist()
        assert list(first.a) == table


def counting_model():
    """Gives every text the number of texts of its call: shows what a call was handed."""

    class CountingModel:
        def open(self):
            return lambda ids, mask: np.full((len(ids), 8), len(ids), np.float32)

    return CountingModel()


def test_repeats_are_run_once(spark, config):
    rows = spark.createDataFrame([(i, "same", f"own {i}") for i in range(8)], "gid long, a string, b string")
    rows = rows.coalesce(1)
    cfg = config(batch_size=8, max_tokens=32)
    shared = wv.embed(rows, cfg, model=counting_model()).collect()
    assert {row.a[0] for row in shared} == {9.0}
    apart = wv.embed(rows, cfg, model=counting_model(), reuse_repeats=False).collect()
    assert {row.a[0] for row in apart} == {16.0}


def test_repeats_are_found_across_batches(spark, config):
    """Forty rows, ten batches, one hot text: it is run once, and every call but the last is full."""
    rows = spark.createDataFrame([(i, "same", f"own {i}") for i in range(40)], "gid long, a string, b string")
    found = wv.embed(rows.coalesce(1), config(max_tokens=32), model=counting_model()).collect()
    sizes = {}
    for row in found:
        sizes[row.b[0]] = sizes.get(row.b[0], 0) + 1
    assert {row.a[0] for row in found} == {8.0}
    assert sizes == {8.0: 39, 1.0: 1}


def test_window_is_bounded(config):
    stock = config(batch_size=256, embedding_dim=1472, max_tokens=128)
    assert window_rows(stock, 5) == 2048
    assert window_rows(config(batch_size=16, max_tokens=2**20), 1) == 16
    assert window_rows(config(batch_size=4096, embedding_dim=1472), 5) == 4096


@pytest.mark.parametrize("window", [1, 100, 10**9])
def test_window_does_not_show(rows, expected, config, model, window, monkeypatch):
    monkeypatch.setattr(embedding, "WINDOW_BYTES", window)
    assert vectors(wv.embed(rows, config(batch_size=3), model=model)) == expected


def test_padded_lengths():
    lengths = np.array([0, 1, 16, 17, 100, 128, 500])
    assert padded_lengths(lengths, 128, False).tolist() == [128] * 7
    assert padded_lengths(lengths, 128, True).tolist() == [16, 16, 16, 32, 128, 128, 128]
    assert padded_lengths(lengths, 10, True).tolist() == [10] * 7


def test_distinct_texts_points_back():
    columns = [pa.array([b"x", b"y", b"x"]), pa.array([b"y", b"z", b"z"])]
    for reuse in (True, False):
        slots, texts = distinct_texts(columns, reuse)
        for column, places in zip(columns, slots):
            assert texts.take(pa.array(places)).equals(column)
    assert len(distinct_texts(columns, True)[1]) == 3


def test_random_texts_with_a_hot_third(spark, config, model):
    """Any Unicode at any length, a third of all rows sharing one text, against plain Python."""
    generator = np.random.default_rng(11)
    planes = [(32, 127), (0, 32), (0xA0, 0x800), (0x800, 0xD800), (0xE000, 0x10000), (0x10000, 0x110000)]

    def text():
        low, high = planes[generator.integers(len(planes))]
        return "".join(map(chr, generator.integers(low, high, generator.integers(0, 40))))

    pairs = [(i, "hot text" if i % 3 == 0 else text(), text()) for i in range(900)]
    rows = spark.createDataFrame(pairs, "gid long, a string, b string").repartition(5)
    for trim in (True, False):
        for max_len in (1, 7, 64):
            cfg = config(batch_size=32, max_tokens=max_len, trim_padding=trim)
            found = vectors(wv.embed(rows, cfg, model=model))
            assert found == {i: [brute.byte_vector(a, max_len), brute.byte_vector(b, max_len)] for i, a, b in pairs}


def test_subword_texts_without_words(spark, config):
    definition = (
        '{"version":"1.0","truncation":null,"padding":null,"added_tokens":[],"normalizer":null,'
        '"pre_tokenizer":{"type":"WhitespaceSplit"},"post_processor":null,"decoder":null,'
        '"model":{"type":"WordLevel","vocab":{"[PAD]":0,"[UNK]":1,"a":2},"unk_token":"[UNK]"}}'
    )
    words = wv.SubwordTokenizer(wv.ship_bytes(spark, definition.encode()))
    rows = spark.createDataFrame([(0, "", "a what")], "gid long, a string, b string")
    loaded = wv.model_from_bytes(spark, check_model(vocabulary=3))
    for trim in (True, False):
        row = wv.embed(rows, config(trim_padding=trim), model=loaded, tokenizer=words).first()
        assert list(row.a) == [0.0] * 8
        two = [(2 * (2 * d + 1)) % 64 + (2 * d + 1) % 64 for d in range(8)]
        assert list(row.b) == [total / 64 / 2 for total in two]


def test_streaming_rows_pass_through(spark, config, model, tmp_path, expected, rows):
    """No operator keeps state, so the same call serves a stream."""
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = (
        wv.embed(stream, config(), model=model)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert vectors(spark.read.parquet(str(tmp_path / "out"))) == expected


def test_vector_width_on_read(rows, config, model):
    found = wv.embed(rows, config(), model=model)
    assert found.filter((F.size("a") != 8) | (F.size("b") != 8)).count() == 0
