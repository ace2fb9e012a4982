"""Writing vectors."""

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from widevec.operators.perspectives import quoted

FILE_BYTES = 1024 * 1024 * 1024


def write_vectors(df, path, width=None):
    """Overwrite ``path`` with Snappy Parquet.

    Spark's commit protocol makes a lost or repeated task harmless. Vector values hardly
    repeat, so dictionary encoding is switched off for them, and left on for all else.
    A row of vectors is far larger than the texts it came from; with ``width`` known, a task
    closes a file after about a gigabyte and starts the next, and a vector of another width,
    or none, fails the job before anything is committed, wherever it came from.
    """
    vectors = [field.name for field in df.schema if isinstance(field.dataType, T.ArrayType)]
    if width:
        df = with_width(df, vectors, width)
    writer = df.write.mode("overwrite").option("compression", "snappy")
    older_layout = df.sparkSession.conf.get("spark.sql.parquet.writeLegacyFormat") == "true"
    leaf = "array" if older_layout else "list.element"
    for name in vectors:
        writer = writer.option(f"parquet.enable.dictionary#{name}.{leaf}", "false")
    if width:
        writer = writer.option("maxRecordsPerFile", max(1, FILE_BYTES // (8 + 4 * width * len(vectors))))
    writer.parquet(path)


def with_width(df, vectors, width):
    """``df`` whose vectors all have ``width`` values: any other is an error of the task."""

    def checked(name):
        vector = F.col(quoted(name))
        wrong = F.concat(F.lit(f"{name} is not a vector of {width} values: size "), F.coalesce(F.size(vector), F.lit(-1)).cast("string"))
        return F.when(F.size(vector) == width, vector).otherwise(F.raise_error(wrong)).alias(name)

    return df.select(*(checked(name) if name in vectors else F.col(quoted(name)) for name in df.columns))


def write_in_parts(rows, vectors_of, path, parts, id_column="gid", width=None):
    """Write ``vectors_of(rows)`` to ``path`` so that a stopped run can go on.

    Rows are dealt to ``parts`` by a hash of their id, and each part is a folder of its own
    with its own commit: the log of what is done are the folders that hold ``_SUCCESS``. A run
    that finds some leaves their rows out and overwrites the others, so that in the end every
    row is there once; rows of one id, nulls too, share a part. Each part scans the needed
    columns again, which is little beside the model. Another number of parts than a folder was
    begun with is refused; that the input is still the same is for the caller to know. Returns
    how many parts this call has written.
    """
    spark = rows.sparkSession
    system, root = _folder(spark, path)
    names = [f"part-{k:05d}-of-{parts:05d}" for k in range(parts)]
    found = [s.getPath().getName() for s in system.listStatus(root)] if system.exists(root) else []
    others = [name for name in found if re.fullmatch(r"part-\d{5}-of-\d{5}", name) and name not in names]
    if others:
        raise ValueError(f"{path} was begun with another number of parts: {sorted(others)[0]}")
    part = F.pmod(F.xxhash64(F.coalesce(F.col(quoted(id_column)).cast("long"), F.lit(0).cast("long"))), F.lit(parts))
    written = 0
    for k, name in enumerate(names):
        folder = f"{path.rstrip('/')}/{name}"
        if not system.exists(_folder(spark, f"{folder}/_SUCCESS")[1]):
            write_vectors(vectors_of(rows.filter(part == k)), folder, width)
            written += 1
    return written


def read_parts(spark, path, schema):
    """The vectors of all parts."""
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/part-*-of-*")


def _folder(spark, path):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found
