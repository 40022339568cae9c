"""Session settings, the shared working folder and staged intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import paths

# Set on every session the library works with. Joins carry no broadcast hints:
# the optimizer broadcasts a side only when its size is under
# spark.sql.autoBroadcastJoinThreshold, and adaptive execution re-checks that
# against the measured size, splitting skewed partitions otherwise.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Many small shuffle partitions, put together to a size that does not grow with the
    # input: a fixed number of them would give a task ever more rows to sort.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # A task that shuffles or groups what it reads holds a part of it.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.caseSensitive": "false",
}

# Only taken up by a JVM that is not running yet. A wide projection compiles to
# one method larger than the JIT takes by default, and then runs interpreted.
JVM_OPTIONS = "-XX:-DontCompileHugeMethods"
LAUNCH_CONF = {
    "spark.driver.extraJavaOptions": JVM_OPTIONS,
    "spark.executor.extraJavaOptions": JVM_OPTIONS,
    # Looking up the Python line of every column costs more than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the library's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_CONF, **LAUNCH_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The session must name that folder: executors cannot see a folder on the
    driver's own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{root.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Used where two passes must see the very same rows in the very same order;
    unlike a cache it survives the loss of any executor.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for table in tables:
        paths.delete(table.sparkSession, table._staged_at)


def observed(seen: Observation) -> dict[str, int]:
    """What an observation has counted; nothing if the optimizer saw that there are no rows to count."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, and known to be empty, so that the optimizer drops joins with it."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0, 1, 1, 1).select(*columns).where(F.lit(False))


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """A few fixed rows as part of the plan, hence known to be small."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields, strict=True)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs))) if rows else empty_table(spark, schema)
