"""Column expressions that phrase a row as text. All of them stay inside whole-stage codegen."""

from pyspark.sql import functions as F


def _column(value):
    return F.col(value) if isinstance(value, str) else value


def is_in(column, values):
    """``column IN (values)``; a null is not in any list. Pushed to the Parquet scan."""
    return _column(column).isin(list(values))


def text_or_empty(column):
    return F.coalesce(_column(column), F.lit(""))


def non_empty(column):
    """Neither null nor the empty string. Blanks count as text: nothing is trimmed."""
    column = _column(column)
    return column.isNotNull() & (column != F.lit(""))


def labelled(label, column):
    """The label followed by the text, or the label alone where there is no text."""
    return F.concat(F.lit(label), text_or_empty(column))


def joined(first, second, separator=", "):
    """Both texts around a separator when there is a second one, else the first.

    A missing first text still gets the separator, so this is not ``concat_ws``.
    """
    tail = F.when(non_empty(second), F.concat(F.lit(separator), _column(second))).otherwise(F.lit(""))
    return F.concat(text_or_empty(first), tail)


def context(*parts):
    """One text out of literals (str) and columns, nulls read as empty."""
    return F.concat(*(F.lit(part) if isinstance(part, str) else text_or_empty(part) for part in parts))
