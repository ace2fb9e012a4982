"""Tokenizing and detokenizing a text column of a table.

With ``pushdown`` a filter on other columns, written afterwards, still reaches the scan; the
new column is then made even where nothing uses it. Either way it is made once.
"""

from pyspark.sql import functions as F

from widevec.functions.tokens import (
    behind_generator,
    decode_udf,
    encode_fixed_udf,
    encode_udf,
    mask_expr,
    segment_ids_expr,
)
from widevec.operators.perspectives import quoted
from widevec.tokenizer import ByteTokenizer

TOKEN_COLUMNS = ("ids", "attention_mask", "token_type_ids")
_SCRATCH = "_widevec_tokens"


def encode(df, text_col, tokenizer, pushdown=False):
    """Add ``ids``: the whole text as tokens, no cut and no padding. A null reads as empty."""
    text = tokenizer.text_input(F.col(quoted(text_col)))
    return _with(df, "ids", encode_udf(tokenizer, pushdown)(text), pushdown)


def tokenize(df, text_col, tokenizer, max_len, pushdown=False):
    """Add (or replace) ``ids``, ``attention_mask`` and ``token_type_ids``, each ``max_len`` long.

    Only the text goes to Python and only the ids come back. The mask and the segment ids
    are built next to them by Spark, and only where they are used.
    """
    if max_len <= 0:
        raise ValueError(f"max_len must be positive, got {max_len}")
    text = F.col(quoted(text_col))
    tokens = encode_fixed_udf(tokenizer, max_len, pushdown)(tokenizer.text_input(text, max_len))
    found = _with(df, _SCRATCH, tokens, pushdown)
    return found.select(
        *(F.col(quoted(name)) for name in df.columns if name not in TOKEN_COLUMNS),
        F.col(_SCRATCH).ids.alias("ids"),
        mask_expr(F.col(_SCRATCH).n, max_len).alias("attention_mask"),
        segment_ids_expr(max_len).alias("token_type_ids"),
    )


def detokenize(df, ids_col, tokenizer, pushdown=False):
    """Add ``text``: what the ids spell. Bytes that are no UTF-8 become U+FFFD."""
    ids = F.col(quoted(ids_col))
    if isinstance(tokenizer, ByteTokenizer):
        content = decode_udf(tokenizer, "binary", pushdown)(ids)
        return _with(df, "text", F.make_valid_utf8(content.cast("string")), pushdown)
    return _with(df, "text", decode_udf(tokenizer, "string", pushdown)(ids), pushdown)


def _with(df, name, column, pushdown):
    return behind_generator(df, column, name) if pushdown else df.withColumn(name, column)
