import json

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import widevec as wv
from widevec.functions.pooling import pool_tensor

HIDDEN = [[1.0, 2.0], [3.0, -4.0], [9.0, 9.0]]
SCHEMA = "i int, h array<array<float>>, m array<int>"
CASES = {
    "mean": ([2.0, -1.0], [0.0, 0.0]),
    "cls": ([1.0, 2.0], [1.0, 2.0]),
    "max": ([3.0, 2.0], [-1e9, -1e9]),
}


@pytest.mark.parametrize("mode", CASES)
@pytest.mark.parametrize("use_python", [True, False])
def test_table_cases(spark, mode, use_python):
    rows = spark.createDataFrame([(0, HIDDEN, [1, 1, 0]), (1, HIDDEN, [0, 0, 0])], SCHEMA)
    found = wv.pool(rows, "h", "m", mode, use_python).orderBy("i").collect()
    assert tuple(list(r.pooled) for r in found) == CASES[mode]
    assert found[0].h is not None


@pytest.mark.parametrize("mode", CASES)
def test_tensor_cases(mode):
    hidden = np.array([HIDDEN, HIDDEN], np.float32)
    mask = np.array([[1, 1, 0], [0, 0, 0]], np.int32)
    assert pool_tensor(hidden, mask, mode).tolist() == list(map(list, CASES[mode]))
    assert pool_tensor(hidden, mask, mode).dtype == np.float32
    assert hidden[0, 2, 0] == 9.0


def test_unknown_mode_means_mean(spark):
    rows = spark.createDataFrame([(0, HIDDEN, [1, 1, 0])], SCHEMA)
    assert list(wv.pool(rows, "h", "m", "median").first().pooled) == CASES["mean"][0]
    assert list(wv.pool(rows, "h", "m", "median", False).first().pooled) == CASES["mean"][0]
    mask = np.array([[1, 1, 0]], np.int32)
    assert pool_tensor(np.array([HIDDEN], np.float32), mask, "median").tolist() == [CASES["mean"][0]]


@pytest.mark.parametrize("mode", CASES)
def test_ragged_rows_and_both_forms(spark, mode):
    generator = np.random.default_rng(3)
    rows, expected = [], {}
    for i in range(300):
        tokens = int(generator.integers(0, 7))
        hidden = (generator.integers(-64, 64, (tokens, 3)) / 16).tolist()
        mask = generator.integers(0, 2, tokens).tolist()
        rows.append((i, hidden, mask))
        expected[i] = brute.pool(hidden, mask, mode) if tokens else []
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for use_python in (True, False):
        for row in wv.pool(table, "h", "m", mode, use_python).collect():
            assert list(row.pooled) == [float(np.float32(x)) for x in expected[row.i]]


@pytest.mark.parametrize("mode", CASES)
def test_wide_vectors_come_in_pieces(spark, mode):
    """400 texts of 64 tokens of 1,000 dimensions are more than is pooled at a time."""
    dims = F.sequence(F.lit(0), F.lit(999))
    vector = lambda t: F.transform(dims, lambda d: ((F.col("id") + t * 3 + d) % 16 / 16).cast("float"))
    rows = spark.range(0, 400, 1, 1).select(
        "id",
        F.transform(F.sequence(F.lit(0), F.lit(63)), vector).alias("h"),
        F.transform(F.sequence(F.lit(0), F.lit(63)), lambda t: (t <= F.col("id") % 64).cast("int")).alias("m"),
    )
    for row in wv.pool(rows, "h", "m", mode).select("id", "pooled").collect():
        shown = (row.id + np.arange(64)[:, None] * 3 + np.arange(1000)) % 16 / 16
        real = row.id % 64 + 1
        expected = {"cls": shown[0], "mean": shown[:real].mean(axis=0), "max": shown[:real].max(axis=0)}[mode]
        assert np.array_equal(np.array(row.pooled, np.float32), expected.astype(np.float32))


@pytest.mark.parametrize("mode", CASES)
@pytest.mark.parametrize("use_python", [True, False])
@pytest.mark.parametrize(
    "hidden, mask, error",
    [
        ([[1.0, 2.0], [1.0]], [1, 1], "differ in width"),
        (HIDDEN, [1], "differ in length"),
        (HIDDEN, [1, 1, 1, 1], "differ in length"),
        (HIDDEN, None, "differ in length"),
        (None, [1], "differ in length"),
        ([[1.0], None], [1, 1], "a null inside"),
        ([[1.0, None]], [1], "a null inside"),
        ([[1.0, 2.0]], [None], "a null inside"),
    ],
)
def test_uneven_input_raises(spark, mode, use_python, hidden, mask, error):
    rows = spark.createDataFrame([(0, hidden, mask)], SCHEMA)
    with pytest.raises(Exception, match=error):
        wv.pool(rows, "h", "m", mode, use_python).collect()


@pytest.mark.parametrize("mode", CASES)
@pytest.mark.parametrize("use_python", [True, False])
def test_empty_rows_and_rows_of_other_widths(spark, mode, use_python):
    cases = [(0, None, None), (1, [], []), (2, HIDDEN, [1, 1, 0]), (3, None, []), (4, [[5.0]], [1]), (5, [[]], [1])]
    rows = spark.createDataFrame(cases, SCHEMA).coalesce(1)
    found = {r.i: list(r.pooled) for r in wv.pool(rows, "h", "m", mode, use_python).collect()}
    assert found == {0: [], 1: [], 2: CASES[mode][0], 3: [], 4: [5.0], 5: []}


@pytest.mark.parametrize(
    "flags, mode",
    [
        ({"pooling_mode_cls_token": True, "pooling_mode_mean_tokens": True}, "cls"),
        ({"pooling_mode_mean_tokens": True, "pooling_mode_max_tokens": True}, "mean"),
        ({"pooling_mode_cls_token": False, "pooling_mode_max_tokens": True}, "max"),
        ({"word_embedding_dimension": 8}, "mean"),
        ({}, "mean"),
        (None, "mean"),
    ],
)
def test_pooling_mode(flags, mode, tmp_path):
    assert wv.pooling_mode(flags) == mode
    if flags is not None:
        path = tmp_path / "pooling.json"
        path.write_text(json.dumps(flags))
        assert wv.read_pooling_mode(str(path)) == mode
    assert wv.read_pooling_mode("") == "mean"


def test_pooling_is_fed_by_tokenize(spark):
    """Tokens to vectors to pooled vectors without leaving the DataFrame."""
    rows = spark.createDataFrame([("ab",), ("",)], "t string")
    tokens = wv.tokenize(rows, "t", wv.ByteTokenizer(), 6)
    dims = F.sequence(F.lit(0), F.lit(7))
    vector = lambda t: F.transform(dims, lambda d: ((t * (2 * d + 1)) % 64 / 64).cast("float"))
    hidden = tokens.withColumn("hidden", F.transform("ids", vector))
    for row in wv.pool(hidden, "hidden", "attention_mask", "mean").collect():
        assert list(row.pooled) == brute.byte_vector(row.t, 6)
