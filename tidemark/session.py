"""Session settings and the helpers that touch the cluster's shared folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side with at most so many rows and bytes may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64_000_000
# A plan that reads so many times those bytes is not tried; from here on the planner does not know.
HOPELESS, UNKNOWN_BYTES = 32, 1 << 60


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if not (master or "").startswith("local"):
        # Many small partitions to begin with; adaptive execution merges what is small.
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = "20000"
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this session's operators wrote below the shared folder; how many paths that were.

    For long sessions, once results were delivered: frames that were not written elsewhere
    cannot be read any more.
    """
    gone = 0
    while _scratch:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        gone += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it from there afterwards.

    Used where a result is read several times and the readers must agree (row
    positions), or where recomputing would repeat a large job.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = shared_dir(df.sparkSession)
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def width(value: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes in memory."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + 16
    if isinstance(kind, T.StructType):
        return sum((width(value[f.name], f.dataType) for f in kind.fields), F.lit(16).cast("long"))
    if isinstance(kind, T.ArrayType):
        add = lambda total, item: total + width(item, kind.elementType)
        return F.coalesce(F.aggregate(value, F.lit(16).cast("long"), add), F.lit(0).cast("long"))
    if isinstance(kind, T.MapType):
        return width(F.map_entries(value), T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])))
    return F.lit(16 if isinstance(kind, T.DecimalType) else 8).cast("long")


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and about how many bytes they take in memory: one parallel pass."""
    columns = [width(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType) for f in df.schema.fields]
    return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(columns, F.lit(8).cast("long"))), F.lit(0))).first())


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` may be broadcast. For inputs that are cheap to read."""
    rows, size = measured(df)
    return rows <= max_rows and size <= max_bytes


def _planned(df: DataFrame) -> tuple[str, int]:
    """The operator that makes the rows of ``df``, and the bytes that the planner expects at most."""
    plan = df._jdf.queryExecution().optimizedPlan()
    try:
        size = int(plan.stats().sizeInBytes())
    except ValueError:  # products of sizes of joins soon have too many digits to be read
        size = UNKNOWN_BYTES
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.getClass().getSimpleName(), size


def small_side(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> tuple[DataFrame, int | None]:
    """A side of a join, and its number of rows if it may be broadcast, else None.

    A side that the planner knows to read far more than may be broadcast comes back as it
    is; it is not evaluated here. Any other is evaluated once and kept, so that it is not
    evaluated again whichever way the join goes, and its rows and bytes are counted.
    """
    made_by, expected = _planned(df)
    if made_by not in ("Aggregate", "GlobalLimit", "LogicalRDD") and HOPELESS * max_bytes < expected < UNKNOWN_BYTES:
        return df, None
    side = df if made_by == "LogicalRDD" else checkpoint(df)
    rows, size = measured(side)
    if rows <= max_rows and size <= max_bytes:
        return side, rows
    # The planner may think otherwise.
    return side.hint("merge"), None


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if the size check passes; otherwise leave the choice to AQE."""
    side, rows = small_side(df, max_rows, max_bytes)
    return side if rows is None else F.broadcast(side)


def require_utc(spark: SparkSession) -> None:
    """Epoch arithmetic on zone-less timestamps needs a UTC session."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise RuntimeError(f"spark.sql.session.timeZone must be UTC, not {zone}")
