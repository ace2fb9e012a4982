"""A whole run: read, embed, write if asked to, and count."""

import logging
import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from widevec.model import load_model
from widevec.operators.embed import embed, infer_vectors, output_schema, prepare_texts
from widevec.sinks.parquet import read_parts, write_in_parts, write_vectors
from widevec.sources.lake import read_source
from widevec.tokenizer import make_tokenizer

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunMetrics:
    """Rows are input rows; every row stands for several sequences, one per text column."""

    source_rows: int
    rows_processed: int
    rows_written: int
    sequences: int
    seconds: float
    rows_per_second: float


@dataclass(frozen=True)
class RunResult:
    """``df`` reads the written vectors, or is the lazy plan if nothing was to be written."""

    df: DataFrame
    metrics: RunMetrics | None = None


def run(spark, cfg, df=None, model=None, tokenizer=None):
    """Run the job ``cfg`` describes, on its source or on the given DataFrame.

    With output enabled the vectors are written and counted on the way, in the same pass.
    With output disabled nothing is run or written: the result is the plan.
    """
    cfg.check_output()
    cfg.check_columns()
    rows = read_source(spark, cfg) if df is None else df
    if not cfg.enable_s3_output:
        return RunResult(embed(rows, cfg, model=model, tokenizer=tokenizer))
    tokenizer = make_tokenizer(spark, cfg) if tokenizer is None else tokenizer
    if cfg.output_parts:
        return _run_in_parts(spark, cfg, rows, model or load_model(spark, cfg), tokenizer)
    # Both counts sit in the stage that writes. Spark counts a task of that stage once however
    # often it runs, which it does not promise for the stage before a shuffle.
    read, done = Observation(), Observation()
    count = F.count(F.lit(1)).alias("rows")
    texts = prepare_texts(rows, cfg, tokenizer).observe(read, count)
    vectors = infer_vectors(texts, cfg, tokenizer, model).observe(done, count)
    started = time.perf_counter()
    write_vectors(vectors, cfg.s3_output_path, cfg.embedding_dim)
    seconds = time.perf_counter() - started
    embedded = done.get["rows"]
    written = spark.read.schema(vectors.schema).parquet(cfg.s3_output_path)
    metrics = RunMetrics(
        source_rows=read.get["rows"],
        rows_processed=embedded,
        # From the footers of the files, so that it shows what a writer loses.
        rows_written=written.count(),
        sequences=embedded * len(cfg.input_columns),
        seconds=seconds,
        rows_per_second=embedded / seconds if seconds > 0 else 0.0,
    )
    log.info("embedded into %s: %s", cfg.s3_output_path, asdict(metrics))
    return RunResult(written, metrics)


def _run_in_parts(spark, cfg, rows, model, tokenizer):
    """The parts that are missing; source rows and throughput are those of this call."""
    seen = []

    def vectors_of(part):
        observed = Observation()
        seen.append(observed)
        texts = prepare_texts(part, cfg, tokenizer).observe(observed, F.count(F.lit(1)).alias("rows"))
        return infer_vectors(texts, cfg, tokenizer, model)

    started = time.perf_counter()
    write_in_parts(rows, vectors_of, cfg.s3_output_path, cfg.output_parts, cfg.id_column, cfg.embedding_dim)
    seconds = time.perf_counter() - started
    done = sum(observed.get["rows"] for observed in seen)
    written = read_parts(spark, cfg.s3_output_path, output_schema(cfg))
    metrics = RunMetrics(
        source_rows=done,
        rows_processed=done,
        # Of all parts, those of earlier calls too.
        rows_written=written.count(),
        sequences=done * len(cfg.input_columns),
        seconds=seconds,
        rows_per_second=done / seconds if seconds > 0 else 0.0,
    )
    log.info("embedded %d parts into %s: %s", len(seen), cfg.s3_output_path, asdict(metrics))
    return RunResult(written, metrics)
