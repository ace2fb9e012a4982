"""Row to texts: the wide projection, its binding to a job, and the long form."""

from pyspark.sql import functions as F


def perspectives(df, gid, spec):
    """One row to ``gid`` plus one named text column per entry of ``spec`` (name to Column)."""
    id_column = F.col(gid) if isinstance(gid, str) else gid
    return df.select(id_column.alias("gid"), *(text.alias(name) for name, text in spec.items()))


def bind_columns(df, cfg, columns=None):
    """The id and the configured text columns, picked by name in configured order.

    Other columns are dropped here, so the scan below never reads them. A null id becomes 0
    and a null text becomes empty: every row is embedded.
    """
    cfg.check_columns()
    names = list(cfg.input_columns if columns is None else columns)
    unknown = [name for name in names if name not in cfg.input_columns]
    if unknown or not names:
        raise ValueError(f"columns {unknown or names} are not among {list(cfg.input_columns)}")
    missing = [name for name in (cfg.id_column, *names) if name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing, the input has {df.columns}")
    return df.select(
        F.coalesce(F.col(quoted(cfg.id_column)).cast("long"), F.lit(0).cast("long")).alias("gid"),
        *(F.coalesce(F.col(quoted(name)).cast("string"), F.lit("")).alias(name) for name in names),
    )


def pack_slots(df, columns, gid="gid"):
    """The long form: one row per text, ``v`` counting the columns in the given order.

    Texts of one row stay together in its partition, so nothing is shuffled.
    """
    slots = F.array(
        *(
            F.struct(
                F.lit(v).alias("v"),
                F.lit(name).alias("column"),
                F.coalesce(F.col(quoted(name)), F.lit("")).alias("text"),
            )
            for v, name in enumerate(columns)
        )
    )
    return df.select(F.col(quoted(gid)).alias("gid"), F.inline(slots))


def quoted(name):
    return "`" + name.replace("`", "``") + "`"
