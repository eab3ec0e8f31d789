"""pandas in and out. Frames carry the time index as their pandas index."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import InvalidArgument
from tidemark.operators.scan import ordered, result_index
from tidemark.schema import INDEX, TS, nanos, quoted

# What runs on the workers travels with the job; they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

READ_BATCH = 65_536


def from_pandas(spark: SparkSession, frame: pd.DataFrame) -> DataFrame:
    """Index -> ``$timestamp``; Arrow transfer.

    Times finer than a microsecond keep what is beyond it in a column of their own, named by
    ``schema.nanos``; frames without such times have no such column.
    """
    data = frame.copy()
    data.insert(0, TS, pd.to_datetime(frame.index))
    data = data.reset_index(drop=True)
    for name in [c for c in data.columns if pd.api.types.is_datetime64_any_dtype(data[c].dtype)]:
        times = data[name]
        rest = (times - times.dt.floor("us")).dt.total_seconds() * 1e9
        data[name] = times.dt.floor("us").astype(pd.DatetimeTZDtype("us", times.dt.tz) if times.dt.tz else "datetime64[us]")
        if rest.any():
            data[nanos(name)] = rest.round().astype("Int64")
    df = spark.createDataFrame(data)
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({n: F.col(quoted(n)).cast("timestamp_ntz") for n in stamps})


def whole_times(frame: pd.DataFrame) -> pd.DataFrame:
    """Times and their nanoseconds put together again."""
    for name in [c for c in frame.columns if nanos(str(c)) in frame.columns]:
        rest = pd.to_numeric(frame.pop(nanos(name))).fillna(0).astype("int64")
        frame[name] = frame[name].astype("datetime64[ns]") + pd.to_timedelta(rest, unit="ns")
    return frame


def to_pandas(df: DataFrame, index: str = TS) -> pd.DataFrame:
    """A result as a frame. It is held by the driver: use it for results, not for tables."""
    frame = whole_times(df.toPandas())
    return frame.set_index(index) if index in frame.columns else frame.rename_axis(INDEX)


def _as_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch as one binary value, in Arrow's stream format."""
    for batch in batches:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as stream:
            stream.write_batch(batch)
        yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["data"])


def iter_arrow(df: DataFrame, size: int = READ_BATCH, *more: str) -> Iterator[pa.Table]:
    """Tables of ``size`` rows, the last one shorter, in time order.

    Rows leave the executors as Arrow batches, one partition after the other, and are cut
    anew here; they are never single objects.
    """
    held, rows = [], 0
    for row in ordered(df, *more).mapInArrow(_as_streams, "data binary").toLocalIterator(prefetchPartitions=True):
        part = pa.ipc.open_stream(row.data).read_all()
        held.append(part)
        rows += part.num_rows
        if rows >= size:
            whole = pa.concat_tables(held)
            for at in range(0, rows - rows % size, size):
                yield whole.slice(at, size)
            held, rows = [whole.slice(rows - rows % size)], rows % size
    if rows:
        yield pa.concat_tables(held)


def iter_pandas(df: DataFrame, size: int = READ_BATCH, *more: str) -> Iterator[pd.DataFrame]:
    """Frames of at most ``size`` rows in time order; one partition is fetched at a time."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    for table in iter_arrow(df, size, *more):
        # Sparse integers stay integers.
        frame = table.to_pandas(integer_object_nulls=True)
        for name in [f.name for f in table.schema if pa.types.is_timestamp(f.type) and f.type.tz]:
            frame[name] = frame[name].dt.tz_convert(zone).dt.tz_localize(None)
        frame = whole_times(frame)
        yield frame.set_index(TS) if TS in frame.columns else frame


def write_frames(
    group, frames: dict[str, pd.DataFrame], *, create: bool = False, shard_size=None, **push_options
) -> int:
    """Push frames into tables of a ``TableGroup`` as one commit.

    With ``create`` missing tables are made to fit their frame, with nanoseconds if its times
    have any. Rows need no order.
    """
    if shard_size is not None and not create:
        raise InvalidArgument("a shard size is only used when tables are created")
    batch = {name: from_pandas(group.spark, frame) for name, frame in frames.items()}
    if create:
        for name, df in batch.items():
            group.create_from(name, df, shard_size)
    return group.push(batch, **push_options)


def read_frame(group, table: str, columns=None, ranges=None) -> pd.DataFrame:
    """One table, or ranges of it, as a frame in time order (held by the driver)."""
    return to_pandas(ordered(group.read(table, columns, ranges)))


def stream_frames(group, tables, columns=None, ranges=None, size: int = READ_BATCH) -> Iterator[pd.DataFrame]:
    """Frames of at most ``size`` rows in time order, for reads of any length."""
    return iter_pandas(group.read(tables, columns, ranges), size)


def stream_tables(group, tables, columns=None, ranges=None, size: int = READ_BATCH) -> Iterator[pa.Table]:
    """As ``stream_frames``, as Arrow tables; nanoseconds stay in columns of their own."""
    return iter_arrow(group.read(tables, columns, ranges), size)


def query_frame(spark: SparkSession, text: str, index: str | int | None = None) -> pd.DataFrame:
    """Result of a query; its index is a column by name or offset, or 0..n-1 named ``$index``."""
    result = spark.sql(text)
    if index is None:
        return result.toPandas().rename_axis(INDEX)
    indexed = result_index(result, index)
    return to_pandas(indexed, indexed.columns[0])
