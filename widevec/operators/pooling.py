"""Pooling token vectors that are already in a table."""

from pyspark.sql import functions as F

from widevec.functions.pooling import pool_expr, pool_udf
from widevec.functions.tokens import behind_generator
from widevec.operators.perspectives import quoted

_HIDDEN, _MASK = "_widevec_hidden", "_widevec_mask"


def pool(df, hidden_col, mask_col, mode, use_python=True, pushdown=False):
    """Add ``pooled array<float>`` from ``array<array<float>>`` and its ``array<int>`` mask.

    ``use_python=False`` gives the higher-order-function form, with the same values and the
    same errors: see ``pool_lists``. With ``pushdown`` later filters on other columns reach
    the scan.
    """
    hidden = F.col(quoted(hidden_col)).cast("array<array<float>>")
    mask = F.col(quoted(mask_col)).cast("array<int>")
    if not use_python:
        return df.withColumn("pooled", pool_expr(hidden, mask, mode))
    kept = [F.col(quoted(name)) for name in df.columns if name != "pooled"]
    # Inlining one struct leaves the rows as they are, but computes both columns before the
    # Python call. Merged into it, nested lambdas in their expressions are more than Spark
    # 4.1 can plan.
    pair = F.struct(hidden.alias(_HIDDEN), mask.alias(_MASK))
    rows = df.select(*kept, F.inline(F.array(pair)))
    pooled = pool_udf(mode, pushdown)(F.struct(_HIDDEN, _MASK))
    if pushdown:
        return behind_generator(rows, pooled, "pooled").select(*kept, "pooled")
    return rows.select(*kept, pooled.alias("pooled"))
