"""What the operators of this subpackage share."""

import contextlib
import ctypes
import gc
import threading
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from widevec.sources.scratch import scratch_path

# What operators keep in a Python worker between tasks, by operator.
_kept = {}
# A worker that has had no task for so many seconds gives up what it keeps: Spark holds on to
# idle workers beside the ones that the next step uses.
IDLE_SECONDS = 5.0
# Of rows that Spark and a Python worker hold at a time.
BATCH_BYTES = 2 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
# So spelt, a limit is one of ``hold_small_batches``, not of the user.
_HELD = f"{BATCH_BYTES}b"
_using, _ended = 0, 0.0
_lock = threading.Lock()
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df, name, mode="errorifexists"):
    """``df`` as a table in the shared folder: computed once, whoever is lost afterwards."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode(mode).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def small_batches(spark):
    """Jobs started inside hand their rows to Python in batches of about ``BATCH_BYTES``, by
    whatever row they end with, unless the session has a limit of its own. Batches are held
    on both sides, by Spark outside its heap, for every task: with the 64 MB and 10,000 rows
    that are Spark's defaults they are a good part of a small executor."""
    if spark.conf.get(_BATCH_LIMIT, None) is not None:
        yield
        return
    spark.conf.set(_BATCH_LIMIT, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_LIMIT)


def hold_small_batches(spark):
    """As ``small_batches``, for jobs that start after the caller has returned a frame, and
    until ``release_batches``."""
    if spark.conf.get(_BATCH_LIMIT, None) is None:
        spark.conf.set(_BATCH_LIMIT, _HELD)


def release_batches(spark):
    """Takes back the limit of ``hold_small_batches``, and no other."""
    if spark.conf.get(_BATCH_LIMIT, None) == _HELD:
        spark.conf.unset(_BATCH_LIMIT)


def keeps(name, cache):
    """Declare a worker's cache, a dict, as that of an operator; returns it."""
    _kept.setdefault(name, []).append(cache)
    return cache


def claiming(name):
    """For a function over a partition's batches: empties what other operators have kept in
    this worker, which Spark may have used for an earlier step, and what its own operator
    keeps once the worker has been idle for some seconds."""

    def decorate(run):
        def guarded(batches):
            _begin(name)
            try:
                yield from run(batches)
            finally:
                _end()

        return guarded

    return decorate


def _begin(name):
    global _using
    with _lock:
        _using += 1
        _empty(but=name)


def _end():
    global _using, _ended
    with _lock:
        _using -= 1
        _ended = time.monotonic()
    idle = threading.Timer(IDLE_SECONDS, _rest)
    idle.daemon = True
    idle.start()


def _rest():
    with _lock:
        if not _using and time.monotonic() - _ended > 0.9 * IDLE_SECONDS:
            _empty()


def _empty(but=None):
    dropped = [cache for name, caches in _kept.items() if name != but for cache in caches if cache]
    for cache in dropped:
        cache.clear()
    if dropped:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)


def utf8(column):
    """The bytes of a text; none for null."""
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")


def mixed(values, salt=0):
    """A well spread 64-bit hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = values + _GOLDEN * np.uint64(salt + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def unit(hashes):
    """Hashes as numbers from 0 up to but not including 1."""
    return (hashes >> np.uint64(11)).astype(np.float64) * 2.0**-53
