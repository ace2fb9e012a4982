"""Token vectors to one vector per text: mean, CLS and max."""

import json
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from widevec.functions.tokens import SLICE_VALUES, call_once, slices
from widevec.sources.files import read_json
from widevec.tokenizer import gather_ragged, list_parts, to_list_array

# Fixed values of the pooling rules.
MASKED_OUT = -1e9
SMALLEST_COUNT = 1e-9
# What is refused, in both forms.
NULL_INSIDE = "a null inside token vectors or attention mask"
UNEVEN_WIDTH = "token vectors differ in width"
UNEVEN_LENGTH = "attention mask and token vectors differ in length"
MODE_FLAGS = {
    "cls": "pooling_mode_cls_token",
    "mean": "pooling_mode_mean_tokens",
    "max": "pooling_mode_max_tokens",
}


def pooling_mode(flags=None):
    """The mode a model's pooling flags ask for: CLS before mean before max, mean by default."""
    flags = flags or {}
    return next((mode for mode, flag in MODE_FLAGS.items() if flags.get(flag)), "mean")


def read_pooling_mode(path, spark=None):
    """As ``pooling_mode``, from a JSON file of flags: on any file system that ``spark`` can
    read, on the driver's disk without one. No path means the default."""
    if not path:
        return pooling_mode()
    if spark is not None:
        return pooling_mode(read_json(spark, path))
    with open(path, encoding="utf-8") as handle:
        return pooling_mode(json.load(handle))


def pool_tensor(hidden, mask, mode):
    """``[S, L, D]`` and ``[S, L]`` to ``[S, D]``, in float32. An unknown mode means mean."""
    if mode == "cls":
        return np.ascontiguousarray(hidden[:, 0, :])
    if mode == "max":
        return np.where(mask[:, :, None] == 0, np.float32(MASKED_OUT), hidden).max(axis=1)
    weights = mask.astype(np.float32)
    total = np.matmul(weights[:, None, :], hidden)[:, 0, :]
    return total / np.maximum(weights.sum(axis=1, keepdims=True), np.float32(SMALLEST_COUNT))


def pool_lists(hidden, mask, mode):
    """Arrow form over ``list<list<float>>`` and ``list<int>``.

    Texts may differ in length, and in width from row to row. A null list is an empty one and
    gives an empty vector; a null inside a list is an error, as are uneven widths in a row and
    a mask of another length.
    """
    vectors = hidden.flatten()
    if vectors.null_count or vectors.flatten().null_count or mask.flatten().null_count:
        raise ValueError(NULL_INSIDE)
    outer = list_parts(hidden)
    inner = list_parts(hidden.values)
    tokens = outer[1]
    widths = gather_ragged(outer[0], tokens, inner[1])
    filled = tokens > 0
    firsts = (np.cumsum(tokens) - tokens)[filled]
    own = np.zeros(len(tokens), np.int64)
    own[filled] = widths[firsts]
    if (widths != np.repeat(own, tokens)).any():
        raise ValueError(UNEVEN_WIDTH)
    mask_starts, mask_lengths, mask_values = list_parts(mask)
    if (mask_lengths != tokens).any():
        raise ValueError(UNEVEN_LENGTH)
    if len(np.unique(own[filled])) > 1:
        parts = [np.flatnonzero(own == width) for width in np.unique(own)]
        found = [pool_lists(hidden.take(pa.array(p)), mask.take(pa.array(p)), mode) for p in parts]
        return pa.concat_arrays(found).take(pa.array(np.argsort(np.concatenate(parts))))
    width = int(own.max(initial=0))
    flat = gather_ragged(gather_ragged(outer[0], tokens, inner[0]), widths, inner[2])
    flat = flat.reshape(len(widths), width).astype(np.float64)
    weights = gather_ragged(mask_starts, tokens, mask_values).astype(np.float64)
    pooled = np.zeros((int(filled.sum()), width))
    if len(firsts) and mode == "cls":
        pooled = flat[firsts]
    elif len(firsts) and mode == "max":
        pooled = np.maximum.reduceat(np.where(weights[:, None] == 0, MASKED_OUT, flat), firsts)
    elif len(firsts):
        count = np.maximum(np.add.reduceat(weights, firsts), SMALLEST_COUNT)
        pooled = np.add.reduceat(flat * weights[:, None], firsts) / count[:, None]
    return to_list_array(pooled.astype(np.float32).ravel(), np.where(filled, width, 0))


def pool_udf(mode, pushdown=False):
    """Arrow UDF over ``struct<hidden, mask>``, sums in double precision."""

    def pool(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pairs in batches:
            hidden, mask = pairs.flatten()
            width = list_parts(hidden.values)[1].max(initial=1)
            start = 0
            for piece in slices(hidden, size=SLICE_VALUES // width):
                yield pool_lists(piece, mask.slice(start, len(piece)), mode)
                start += len(piece)

    return call_once(arrow_udf(pool, T.ArrayType(T.FloatType(), False)), pushdown)


def pool_expr(hidden, mask, mode):
    """The same without Python, as higher-order functions: a lambda call for each value, so
    rather for short texts and narrow vectors."""
    hidden = F.coalesce(hidden, F.array().cast("array<array<float>>"))
    mask = F.coalesce(mask, F.array().cast("array<int>"))
    null_inside = F.exists(
        hidden, lambda vector: vector.isNull() | F.exists(vector, lambda value: value.isNull())
    ) | F.exists(mask, lambda m: m.isNull())
    width = F.size(F.get(hidden, F.lit(0)))
    return (
        F.when(null_inside, F.raise_error(F.lit(NULL_INSIDE)))
        .when(F.exists(hidden, lambda vector: F.size(vector) != width), F.raise_error(F.lit(UNEVEN_WIDTH)))
        .when(F.size(hidden) != F.size(mask), F.raise_error(F.lit(UNEVEN_LENGTH)))
        .otherwise(_pooled_expr(hidden, mask, mode))
    )


def _pooled_expr(hidden, mask, mode):
    if mode == "cls":
        return F.coalesce(F.get(hidden, F.lit(0)), F.array().cast("array<float>"))
    tokens = F.sequence(F.lit(0), F.greatest(F.size(hidden), F.lit(1)) - 1)
    width = F.greatest(F.size(F.get(hidden, F.lit(0))), F.lit(0))
    # A sequence never is empty, so that of no dimension is cut out of that of one.
    dims = F.slice(F.sequence(F.lit(0), F.greatest(width, F.lit(1)) - 1), F.lit(1), width)

    def value(i, d):
        return F.get(F.get(hidden, i), d).cast("double")

    def shown(i, d):
        return F.when(F.get(mask, i) == 0, F.lit(MASKED_OUT)).otherwise(value(i, d))

    if mode == "max":
        return F.transform(dims, lambda d: F.array_max(F.transform(tokens, lambda i: shown(i, d))).cast("float"))
    count = F.greatest(
        F.aggregate(mask, F.lit(0.0), lambda total, m: total + m.cast("double")), F.lit(SMALLEST_COUNT)
    )
    return F.transform(
        dims,
        lambda d: (
            F.aggregate(tokens, F.lit(0.0), lambda total, i: total + value(i, d) * F.get(mask, i)) / count
        ).cast("float"),
    )
