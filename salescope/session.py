"""Session helpers.

On a cluster the session is created by the platform; the library only reads
its settings.  ``build_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on: UTC so that timestamps mean the same thing as
# in the oracle, AQE for coalescing / skew-join splitting at run time.  Methods of more
# than 8000 bytes of code are never compiled by the JVM: Spark then splits them.
_DEFAULTS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "salescope", extra: dict | None = None) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("SALESCOPE_DRIVER_MEMORY", "16g")))
    for k, v in {**_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def prepared(spark: SparkSession) -> SparkSession:
    """The session with what the queries need: a shared folder, and no method too long for the JVM to compile.

    The platform's own limit stays if it is lower.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(limit, str(min(int(spark.conf.get(limit, "65535")), int(_DEFAULTS[limit]))))
    checkpoint_dir(spark)
    return spark


#: Bytes of the input (Parquet) to a partition that a shuffle begins with.
SHUFFLE_BYTES = 8 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_PLATFORM: dict[str, str | None] = {}


def shuffle_by_size(spark: SparkSession, input_bytes: int) -> None:
    """Shuffles begin in a partition for each ``SHUFFLE_BYTES`` of the input, at least the platform's number.

    With a fixed number a task's share grows with the input until its sorts spill; small
    partitions are brought together again when a shuffle is read.  0 bytes: the platform's own number.
    """
    own = _PLATFORM.setdefault(spark.sparkContext.applicationId, spark.conf.get(_INITIAL, None))
    least = int(own or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-input_bytes // SHUFFLE_BYTES)
    if wanted > least:
        spark.conf.set(_INITIAL, str(wanted))
    elif own is None:
        spark.conf.unset(_INITIAL)
    else:
        spark.conf.set(_INITIAL, own)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one; only when it is
    unset and the master is local (tests, the bench) a scratch folder is created
    and registered.  On a cluster without one this is an error, as executors do
    not share their local disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="salescope-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written as Parquet to a new path of the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
