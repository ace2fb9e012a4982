"""Reading the rows to embed, and the Spark settings that reach a lake and an object store."""

from pyspark.resource import ExecutorResourceRequests, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import functions as F

from widevec.config import SOURCE_KEYS


def read_source(spark, cfg):
    """The DataFrame behind the one source the job names.

    ``source_table`` takes a three-part catalog name, ``source_query`` any Spark SQL and
    ``source_path`` Parquet files. Errors in the name or the query raise here.
    """
    named = [key for key in SOURCE_KEYS if getattr(cfg, key)]
    if len(named) != 1:
        raise ValueError(f"name exactly one of {SOURCE_KEYS}, got {named or 'none'}")
    if cfg.source_query:
        return spark.sql(cfg.source_query)
    if cfg.source_table:
        return spark.table(cfg.source_table)
    return spark.read.parquet(cfg.source_path)


def text_batch(df):
    """The first two columns of any query as ``gid long, text string``, free of nulls."""
    if len(df.columns) < 2:
        raise ValueError(f"an id and a text column are needed, the query gives {df.columns}")
    # By position: the two columns may well share a name.
    found = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return found.select(
        F.coalesce(F.col("c0").cast("long"), F.lit(0).cast("long")).alias("gid"),
        F.coalesce(F.col("c1").cast("string"), F.lit("")).alias("text"),
    )


def object_store_conf(
    endpoint,
    path_style=True,
    ssl=False,
    credentials="software.amazon.awssdk.auth.credentials.EnvironmentVariableCredentialsProvider",
    magic_committer=False,
):
    """Session settings for an S3-compatible store, for reading and writing alike.

    Keys come from the named credentials provider and never appear in settings, SQL or logs.
    ``magic_committer`` commits output without renaming files, which an object store can only
    do by copying them; it needs Spark's cloud integration module.
    """
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.aws.credentials.provider": credentials,
    }
    if magic_committer:
        commit = "org.apache.spark.internal.io.cloud"
        conf["spark.hadoop.fs.s3a.committer.name"] = "magic"
        conf["spark.sql.sources.commitProtocolClass"] = f"{commit}.PathOutputCommitProtocol"
        conf["spark.sql.parquet.output.committer.class"] = f"{commit}.BindingParquetOutputCommitter"
    return conf


def catalog_conf(name, implementation, **properties):
    """Session settings that attach a lake catalog as ``name``, for any Spark catalog plugin."""
    prefix = f"spark.sql.catalog.{name}"
    return {prefix: implementation} | {f"{prefix}.{key}": str(value) for key, value in properties.items()}


def task_conf(
    cfg, slots=None, cpus_per_task=1, gpus_per_task=0.0, split_bytes="16m"
):
    """Session settings that suit embedding, where a little input means a lot of work.

    Small scan splits spread inference without a shuffle. ``slots``, the tasks the cluster
    runs at once, gives a small input at least a task for each. Splits never grow with the
    table, so neither does what a lost executor has to repeat. An Arrow batch that is a
    multiple of the micro-batch leaves no short remainder in every batch.

    Every task slot has a Python worker with a model of its own, which runs on
    ``cpus_per_task`` threads: more of them means fewer copies of a large model in memory.
    """
    conf = {
        "spark.sql.files.maxPartitionBytes": split_bytes,
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(cfg.batch_size * max(1, 4096 // cfg.batch_size)),
        "spark.python.worker.reuse": "true",
    }
    if slots:
        conf["spark.sql.files.minPartitionNum"] = str(slots)
    if cpus_per_task > 1:
        conf["spark.task.cpus"] = str(cpus_per_task)
    if gpus_per_task:
        conf["spark.task.resource.gpu.amount"] = str(gpus_per_task)
    return conf


def inference_profile(cpus_per_task=1, gpus_per_task=0.0, executor_cores=None, executor_memory=None, gpus=0, gpu_script=None):
    """Resources of the model's stage alone, for ``embed(..., profile=)``.

    Without executor settings the tasks use the executors that the session has, with as many
    cores and GPUs each as said here. With them, and dynamic allocation, Spark starts
    executors of that size for this stage and lets them go after it; ``gpu_script`` is the
    discovery script of the cluster.
    """
    tasks = TaskResourceRequests().cpus(cpus_per_task)
    if gpus_per_task:
        tasks = tasks.resource("gpu", gpus_per_task)
    builder = ResourceProfileBuilder().require(tasks)
    if executor_cores or executor_memory or gpus:
        executors = ExecutorResourceRequests()
        if executor_cores:
            executors = executors.cores(executor_cores)
        if executor_memory:
            executors = executors.memory(executor_memory)
        if gpus:
            executors = executors.resource("gpu", gpus, gpu_script or "")
        builder = builder.require(executors)
    return builder.build
