"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings the jobs rely on. Shuffle parallelism, memory and the broadcast
# threshold stay the cluster's own: AQE sizes the reducers, and a side is only
# broadcast when its measured size is under the session's threshold.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods above 8,000 bytes of bytecode; a longer
    # generated stage would run interpreted, so let Spark split it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "skeinmart", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
        .config("spark.sql.shuffle.partitions", conf.pop("shuffle_partitions", "8"))
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings of this package to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# One reducer's share of the input.
_BYTES_PER_REDUCER = 512 << 20


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the reducers of a shuffle to fit the input; never lowers the session's setting.

    AQE merges reducers that turn out small, but it cannot make more of them.
    """
    key = "spark.sql.shuffle.partitions"
    wanted = -(-input_bytes // _BYTES_PER_REDUCER)
    if wanted > int(spark.conf.get(key)):
        spark.conf.set(key, str(wanted))
    return int(spark.conf.get(key))


# A task's share of packed files: rows of some 26 bytes on disk take six times that and more in a sort.
_BYTES_PER_SPLIT = 32 << 20


def limit_splits(spark: SparkSession) -> None:
    """Lower the bytes that one task reads of files, so that its sort or its hash table fits a task's memory; never raises the session's setting."""
    key = "spark.sql.files.maxPartitionBytes"
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > _BYTES_PER_SPLIT:
        spark.conf.set(key, f"{_BYTES_PER_SPLIT}b")


# Spark's own bound of an Arrow batch is 64 MB; a Python worker holds a batch several times over, and keeps what it once took.
_BYTES_PER_BATCH = 4 << 20


def limit_batches(spark: SparkSession) -> None:
    """Lower the bytes of an Arrow batch that goes to a Python worker, so that its memory depends neither on the
    number of rows nor on their length; never raises the session's setting. Read when a job begins."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() > _BYTES_PER_BATCH:
        spark.conf.set(key, f"{_BYTES_PER_BATCH}b")


_own_scratch: dict[str, str] = {}
_cleared: dict[str, int] = {}


def shared_dir(spark: SparkSession) -> str:
    """Root of the folder where intermediate tables are written.

    The cluster names a folder every executor reaches in ``spark.checkpoint.dir``
    (or by ``setCheckpointDir``). Only a local session may go without: it gets a
    temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if configured:
        nth = _cleared.get(context.applicationId)
        return f"{configured.rstrip('/')}/skeinmart/{context.applicationId}{f'-{nth}' if nth else ''}"
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors reach")
    if context.applicationId not in _own_scratch:
        _own_scratch[context.applicationId] = tempfile.mkdtemp(prefix="skeinmart-")
    return _own_scratch[context.applicationId]


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; frames that read them fail afterwards.

    For the end of a job: the library itself can't know when a caller is done with a frame.
    What is written later goes to a new folder.
    """
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    _own_scratch.pop(context.applicationId, None)
    _cleared[context.applicationId] = _cleared.get(context.applicationId, 0) + 1


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, never used path under :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back; options are the Parquet writer's.

    Runs a job. The copy survives lost executors, is computed once however often
    it is used, and its file size is what Spark's broadcast decision looks at.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """:func:`materialize`, and the number of rows written (from the same job)."""
    seen = Observation()
    written = materialize(df.observe(seen, F.count("*").alias("n")), label)
    return written, seen.get["n"]
