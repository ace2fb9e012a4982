"""Token columns: what Spark can build by itself, and the Arrow UDFs for the rest.

By default the UDFs are declared non-deterministic although they are not: it tells Catalyst
never to copy the call. Otherwise a filter or an ``explode`` on their result would be pushed
below them together with a second call, doubling the work. The price is that a filter on
another column stays above the call too. ``behind_generator`` keeps both properties, a single
call and filters that reach the scan, for a deterministic UDF; Spark then makes the column
even where nothing uses it.
"""

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from widevec.operators.perspectives import quoted
from widevec.tokenizer import BYTE_OFFSET, EOS_ID, PAD_ID, list_parts, pad_fixed, to_list_array

TOKENS = T.ArrayType(T.IntegerType(), False)
FIXED_TOKENS = T.StructType([T.StructField("ids", TOKENS), T.StructField("n", T.IntegerType())])

# Values made at a time, so that a batch of very long lists is not expanded at once. Encoding
# and decoding hold some hundred bytes for each, whatever the size of a batch.
SLICE_VALUES = 512 * 1024
SLICE_ROWS = 4096


def slices(array, rows=SLICE_ROWS, size=SLICE_VALUES):
    """Consecutive pieces of a ragged array, bounded in rows and in values; one row is never cut."""
    ends = np.cumsum(list_parts(array)[1])
    start = used = 0
    while start < len(array):
        fits = int(np.searchsorted(ends, used + size, side="right"))
        stop = max(start + 1, min(fits, start + rows))
        yield array.slice(start, stop - start)
        start, used = stop, int(ends[stop - 1])


def call_once(udf, pushdown=False):
    """A UDF as it may be planned: copied never, or as Catalyst likes, behind a generator."""
    return udf if pushdown else udf.asNondeterministic()


def behind_generator(df, column, name):
    """``df`` with ``column`` as ``name``, replacing one of that name in its place.

    Inlining an array of one struct leaves the rows as they are. Filters on other columns
    pass below a generator, those on its result cannot, and nothing is merged through it.
    """
    kept = [field for field in df.columns if field != name]
    found = df.select(*(F.col(quoted(field)) for field in kept), F.inline(F.array(F.struct(column.alias(name)))))
    return found.select(*(F.col(quoted(field)) for field in (df.columns if name in df.columns else found.columns)))


def encode_udf(tokenizer, pushdown=False):
    """Texts to id lists of their own length."""

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = tokenizer.open()
        for texts in batches:
            for piece in slices(texts):
                yield to_list_array(*encoder.encode(piece))
            # Not to be held while the next one is read.
            texts = piece = None

    return call_once(arrow_udf(encode, TOKENS), pushdown)


def encode_fixed_udf(tokenizer, max_len, pushdown=False):
    """Texts to ``ids`` of length ``max_len`` and the number ``n`` of them that are real."""

    rows = max(1, min(SLICE_ROWS, SLICE_VALUES // max_len))

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = tokenizer.open()
        for texts in batches:
            for piece in slices(texts, rows):
                ids, mask = pad_fixed(*encoder.encode(piece), max_len)
                lists = to_list_array(ids.ravel(), [max_len] * len(ids))
                real = pa.array(mask.sum(axis=1), pa.int32())
                yield pa.StructArray.from_arrays([lists, real], names=["ids", "n"])
            texts = piece = None

    return call_once(arrow_udf(encode, FIXED_TOKENS), pushdown)


def decode_udf(tokenizer, result_type, pushdown=False):
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = tokenizer.open()
        for ids in batches:
            for piece in slices(ids):
                yield encoder.decode(piece)
            ids = piece = None

    return call_once(arrow_udf(decode, result_type), pushdown)


def mask_expr(real, max_len):
    """Ones for the first ``real`` positions, zeros for the rest."""
    ones = F.array_repeat(F.lit(1), real)
    return F.concat(ones, F.array_repeat(F.lit(0), F.lit(max_len) - real))


def segment_ids_expr(max_len):
    """One text is one segment: all zeros."""
    return F.array_repeat(F.lit(0), F.lit(max_len))


def byte_ids_expr(text, max_len=None):
    """Byte token ids as plain Spark SQL.

    Read as ISO-8859-1 the bytes are characters of the same numbers. Splitting takes them
    apart in one pass, where picking them out by position would be quadratic.
    """
    content = F.coalesce(text, F.lit("")).cast("binary")
    if max_len is not None:
        content = F.substring(content, 1, max_len - 1)
    size = F.octet_length(content)
    # Splitting the empty text gives one empty piece, which the slice drops.
    pieces = F.slice(F.split(F.decode(content, "ISO-8859-1"), ""), F.lit(1), size)
    ids = F.transform(pieces, lambda piece: F.ascii(piece) + BYTE_OFFSET)
    parts = [ids, F.array(F.lit(EOS_ID))]
    if max_len is not None:
        parts.append(F.array_repeat(F.lit(PAD_ID), F.lit(max_len - 1) - size))
    return F.concat(*parts)
