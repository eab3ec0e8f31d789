"""Stored tables: sharded Parquet with all-or-nothing pushes.

Layout below the group's root::

    data/_v=<version>/_shard=<n>/part-*.parquet   rows, sorted by table and time
    replaced/_v=<version>/   (table, shard) whose rows in older versions are obsolete
    changes/_v=<version>/    change log: time, transaction, table, begin, end
    symbols/_v=<version>/    numbers that a push gave to new symbols, by symbol table
    log/<number>.json        one small file per commit; its appearance publishes the version

Shards are directories, so a range predicate prunes them. Tables are not: rows are
clustered by table inside a shard, which keeps files large for fleets of small tables
and still lets Parquet statistics skip the others.

Row data, shard lists and the change log are written and read by Spark jobs; the
driver only sees the commit files. Readers list the published versions, so half-written
ones are invisible, and no file is overwritten while a plan still reads it.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import AliasAlreadyExists, AliasNotFound, CommitConflict, DamagedCommit, InvalidArgument
from tidemark.functions.time import MICROS, floor_div, micros, nanosecond, timestamp
from tidemark.operators import write as W
from tidemark.operators.ranges import _shards, between, between_fine, ending, in_range_set, in_ranges
from tidemark.operators.running import row_index
from tidemark.operators.scan import project
from tidemark.schema import SHARD, TABLE, TS, ColumnInfo, ColumnType, TableSchema, nanos, quoted
from tidemark.session import checked_broadcast, checkpoint, fits, require_utc
from tidemark.sources.pruning import Intervals, covered_numbers, covered_times, cut, joined, within

_SYMBOL_SCHEMA = "symtable string, symbol_id bigint, symbol string"
_CHANGE_SCHEMA = "log_ts timestamp_ntz, transaction_id bigint, table string, begin timestamp_ntz, end timestamp_ntz"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


_NUMBER = "CAST(split_part(_v, '-', 1) AS BIGINT)"


def _number(column: str) -> Column:
    """Commit number of a version name ``<number>-<random>``."""
    return F.split_part(column, F.lit("-"), F.lit(1)).cast("bigint")


def _of_shards(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """Rows of the given (table, shard) pairs, which are read twice; other directories stay closed."""
    rows = rows.where(within(F.col(SHARD), covered_numbers(shards, SHARD)))
    return rows.join(checked_broadcast(shards), ["_table", SHARD], "left_semi")


def _physical(column: ColumnInfo) -> str:
    """Stored name: tables of one group may use a name with different types or symbol tables."""
    kind = f"{column.type.value}__{column.symtable}" if column.symtable else column.type.value
    return f"{column.name}__{kind}"


# Stored rows hold numbers in place of symbols, and nanoseconds like any other column.
REST = _physical(ColumnInfo(nanos(TS), ColumnType.INT64))


class TableGroup:
    """Tables under one root folder that can be written together."""

    def __init__(self, spark: SparkSession, root: str):
        require_utc(spark)
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._io = jvm.org.apache.commons.io.IOUtils
        self._commits: dict[int, dict] = {}

    # ------------------------------------------------------------ commits

    def _load(self) -> list[dict]:
        """All published commits in order; only new files are read."""
        for number, text in self._texts(self._unread()):
            try:
                self._commits[number] = json.loads(text)
            except ValueError as error:  # commits appear whole, so this one was damaged
                raise DamagedCommit(f"commit {number} of {self.root} cannot be read") from error
        return [self._commits[n] for n in sorted(self._commits)]

    def _unread(self) -> dict:
        """Commit files not read yet, by number."""
        folder = self._path(f"{self.root}/log")
        if not self._fs.exists(folder):
            return {}
        files = {int(s.getPath().getName().split(".")[0]): s for s in self._fs.listStatus(folder)}
        return {n: s for n, s in files.items() if n not in self._commits}

    def _texts(self, files: dict) -> list[tuple[int, str]]:
        if len(files) > 100:  # a long history is read by tasks
            paths = [s.getPath().toString() for s in files.values()]
            rows = self.spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_name").alias("f"), "value")
            return [(int(r.f.split(".")[0]), r.value) for r in rows.collect()]
        texts = []
        for number, status in files.items():
            stream = self._fs.open(status.getPath())
            try:
                texts.append((number, self._io.toString(stream, "UTF-8")))
            finally:
                stream.close()
        return texts

    def _publish(self, number: int, entry: dict) -> int:
        """Make the commit file appear, whole; exactly one writer can publish a number.

        It is written under another name and moved. A move fails if the target is there; local
        file systems would replace it, so there the file gets a second name instead.
        """
        entry = {"number": number, **entry}
        staged = self._path(f"{self.root}/staging/{uuid.uuid4().hex}.json")
        final = self._path(f"{self.root}/log/{number:020d}.json")
        out = self._fs.create(staged, False)
        out.write(bytearray(json.dumps(entry), "utf-8"))
        out.close()
        self._fs.mkdirs(final.getParent())
        if self._fs.getUri().getScheme() == "file":
            try:
                os.link(staged.toUri().getPath(), final.toUri().getPath())
                published = True
            except FileExistsError:
                published = False
        else:
            published = not self._fs.exists(final) and self._fs.rename(staged, final)
        self._fs.delete(staged, False)
        if not published:
            raise CommitConflict(f"version {number} was committed by another writer")
        self._commits[number] = entry
        return number

    def _next(self) -> int:
        """Number for a new commit."""
        return max([0, *[c["number"] for c in self._load()]]) + 1

    def committed(self, batch_id: str) -> int | None:
        """Version that holds a batch, if it was pushed before."""
        for commit in self._load():
            if commit.get("batch_id") == batch_id:
                return commit["number"]
        return None

    # ------------------------------------------------------------ table definitions

    def _catalog(self) -> dict[str, tuple[TableSchema, int]]:
        """Table name -> (schema, number of the commit that created it)."""
        tables: dict[str, tuple[TableSchema, int]] = {}
        for commit in self._load():
            for name, spec in (commit.get("tables") or {}).items():
                if spec is None:
                    tables.pop(name, None)
                    continue
                schema = TableSchema(
                    name,
                    tuple(ColumnInfo(n, ColumnType(t), s) for n, t, s in spec["columns"]),
                    timedelta(milliseconds=spec["shard_ms"]),
                    timedelta(milliseconds=spec["ttl_ms"]),
                )
                tables[name] = (schema, tables[name][1] if name in tables else commit["number"])
        return tables

    @staticmethod
    def _spec(schema: TableSchema) -> dict:
        return {
            "columns": [(c.name, c.type.value, c.symtable) for c in schema.columns],
            "shard_ms": schema.shard_ms,
            "ttl_ms": schema.ttl // timedelta(milliseconds=1),
        }

    def tables(self) -> list[str]:
        return sorted(self._catalog())

    def exists(self, name: str) -> bool:
        return name in self._catalog()

    def schema(self, name: str) -> TableSchema:
        catalog = self._catalog()
        if name not in catalog:
            raise AliasNotFound(f"table '{name}' does not exist")
        return catalog[name][0]

    def create(self, *schemas: TableSchema) -> None:
        """Create tables in one commit."""
        known = self._catalog()
        for schema in schemas:
            if schema.name in known:
                raise AliasAlreadyExists(f"table '{schema.name}' exists already")
        self._publish(self._next(), {"kind": "create", "tables": {s.name: self._spec(s) for s in schemas}})

    def create_from(self, name: str, df: DataFrame, shard_size: timedelta | None = None) -> TableSchema:
        """Create a table that fits ``df``; an existing table is kept as it is."""
        schema = TableSchema.infer(name, df, shard_size)
        if not self.exists(name):
            self.create(schema)
        return self.schema(name)

    def add_columns(self, name: str, columns: list[ColumnInfo]) -> None:
        """Append columns; they are null in older rows."""
        schema = self.schema(name).extended(columns)
        self._publish(self._next(), {"kind": "alter", "tables": {name: self._spec(schema)}})

    def drop(self, name: str, missing_ok: bool = False) -> None:
        if not self.exists(name):
            if missing_ok:
                return
            raise AliasNotFound(f"table '{name}' does not exist")
        self._publish(self._next(), {"kind": "drop", "tables": {name: None}})

    def describe(self, name: str, points: bool = False) -> DataFrame:
        """Columns as rows: index (the time index is -1), name, type, symbol table.

        With ``points`` also how many rows have a value in the column.
        """
        columns = list(enumerate(self.schema(name).with_index()))
        rows = [(i - 1, c.name, c.type.value, c.symtable) for i, c in columns]
        described = self.spark.createDataFrame(rows, "index int, name string, type string, symtable string")
        if not points:
            return described
        counts = self.read(name, decode=False).agg(*[F.count(quoted(c.name)).alias(f"_{i}") for i, c in columns])
        pairs = F.array(*[F.struct(F.lit(i - 1).alias("_of"), F.col(f"_{i}").alias("points")) for i, _ in columns])
        counted = counts.select(F.explode(pairs).alias("p")).select("p.*")
        return described.join(F.broadcast(counted), F.col("index") == F.col("_of")).drop("_of")

    # ------------------------------------------------------------ reading

    def _stored_schema(self, catalog) -> T.StructType:
        fields = {TS: T.TimestampNTZType()}
        for schema, _ in catalog.values():
            for column in schema.columns:
                fields[_physical(column)] = T.LongType() if column.symtable else column.type.spark_type
        fields |= {"_v": T.StringType(), "_table": T.StringType(), SHARD: T.LongType()}
        return T.StructType([T.StructField(n, t) for n, t in fields.items()])

    def _floors(self, commits, names: list[str]) -> DataFrame | None:
        """(table, shard) -> oldest version number whose rows count; None if all do."""
        replacing = [c for c in commits if c.get("replaces")]
        if not replacing:
            return None
        return (
            self.spark.read.option("basePath", f"{self.root}/replaced")
            .schema("_table string, _shard bigint, _v string")
            .parquet(*[f"{self.root}/replaced/_v={c['version']}" for c in replacing])
            .where(F.col("_table").isin(names))
            .groupBy("_table", SHARD)
            .agg(F.max(_number("_v")).alias("_floor"))
        )

    def _rows(self, names: list[str], catalog, shards: Column | None = None) -> DataFrame:
        """Stored rows of the tables with their ``_shard``, all stored columns."""
        stored = self._stored_schema(catalog)
        commits = [c for c in self._load() if c.get("version")]
        filled = self._filled()
        if not filled:
            return self.spark.createDataFrame([], stored)
        rows = (
            self.spark.read.option("basePath", f"{self.root}/data")
            .schema(stored)
            .parquet(*[f"{self.root}/data/_v={c['version']}" for c in filled])
            .where(F.col("_table").isin(names))
        )
        # Rows of a dropped table of the same name are older than the table.
        limits = [(n, catalog[n][1]) for n in names if catalog[n][1] > filled[0]["number"]]
        rows = self._above(rows, limits, _number("_v"), "bigint")
        if shards is not None:
            rows = rows.where(shards)
        floors = self._floors(commits, names)
        if floors is None:
            return rows
        side = F.broadcast(floors) if fits(floors) else floors
        joined = rows.join(side, ["_table", SHARD], "left")
        return joined.where("_floor IS NULL OR " + _NUMBER + " >= _floor").drop("_floor")

    def _above(self, rows: DataFrame, limits: list[tuple], value: Column, kind: str) -> DataFrame:
        """Rows whose ``value`` reaches their table's limit; tables without one stay whole.

        One limit for all becomes a filter; more are joined, so that any number of tables
        makes one plan of the same size. There is one short row per table.
        """
        if not limits:
            return rows
        distinct = {limit for _, limit in limits}
        if len(distinct) == 1:
            return rows.where(~F.col("_table").isin([n for n, _ in limits]) | (value >= F.lit(distinct.pop()).cast(kind)))
        side = self.spark.createDataFrame(limits, f"_table string, _limit {kind}")
        return rows.join(F.broadcast(side), "_table", "left").where(F.col("_limit").isNull() | (value >= F.col("_limit"))).drop("_limit")

    def _shard_filter(self, names, catalog, ranges) -> Column | None:
        """Shards that ranges can touch; tables may differ in shard size."""
        if not ranges:
            return None
        condition = F.lit(False)
        for size in {catalog[n][0].shard_size for n in names}:
            same = [n for n in names if catalog[n][0].shard_size == size]
            for begin, end in ranges:
                condition = condition | (F.col("_table").isin(same) & _shards(begin, end, size))
        return condition

    def _by_size(self, names, catalog) -> dict[int, list[str]]:
        """Tables by the length of their shards in microseconds."""
        sizes: dict[int, list[str]] = {}
        for name in names:
            sizes.setdefault(catalog[name][0].shard_size // MICROS, []).append(name)
        return sizes

    def _shards_at(self, names, catalog, times: Intervals) -> Column:
        """Shards that stretches of microseconds can touch."""
        condition = F.lit(False)
        for size, same in self._by_size(names, catalog).items():
            numbers = within(F.col(SHARD), joined([(a // size, b // size) for a, b in times]))
            condition = condition | (F.col("_table").isin(same) & numbers)
        return condition

    def _inside(self, names, catalog, begin: Column, end: Column) -> Column:
        """Shards that lie in [begin, end) as a whole; both in microseconds."""
        condition = F.lit(False)
        for size, same in self._by_size(names, catalog).items():
            whole = (F.col(SHARD) * size >= begin) & ((F.col(SHARD) + 1) * size <= end)
            condition = condition | (F.col("_table").isin(same) & whole)
        return condition

    def _listed_shards(self, rows: DataFrame) -> DataFrame:
        """Shard numbers of the files below ``rows``, from their paths alone."""
        # The list of paths that planning the read makes anyway; it does not pass through Python.
        paths = F.filter(F.lit(rows._jdf.inputFiles()), lambda path: path.contains(f"/{SHARD}="))
        numbers = F.transform(paths, lambda path: F.regexp_extract(path, f"/{SHARD}=(-?[0-9]+)/", 1).cast("bigint"))
        return self.spark.range(1).select(F.explode(F.array_distinct(numbers)).alias(SHARD))

    @staticmethod
    def _extent(staged: DataFrame) -> tuple:
        """First and last time of a batch, and their nanoseconds."""
        if REST not in staged.columns:
            return *W.extent(staged), (0, 0)
        whole = F.struct(F.col(quoted(TS)).alias("at"), F.coalesce(quoted(REST), F.lit(0)).alias("rest"))
        first, last = staged.agg(F.min(whole), F.max(whole)).first()
        return first["at"], last["at"], (first["rest"], last["rest"])

    def _truncated(self, names, catalog, begin, end, rests: tuple[int, int], closed: bool) -> tuple[DataFrame, DataFrame]:
        """What of a time range's shards stays, and the (table, shard) pairs that are replaced.

        Shards inside the range are replaced unread; for a single table they are not even
        opened. Rows are read from the shards at its two ends.
        """
        stored = self._rows(names, catalog, self._shard_filter(names, catalog, [(begin, end)]))
        if REST in stored.columns:
            gone = between_fine(F.col(quoted(TS)), F.col(quoted(REST)), begin, end, closed, rests)
        else:
            gone = between(F.col(quoted(TS)), begin, end, closed=closed)
        # Shards are cut at whole microseconds.
        first = micros(timestamp(begin)) + (1 if rests[0] else 0)
        last = micros(ending(timestamp(begin), end)) + (1 if closed and (REST not in stored.columns or rests[1] == 999) else 0)
        inside = self._inside(names, catalog, first, last)
        edges = stored.where(~inside)
        if len(names) == 1:
            pairs = self._listed_shards(stored).select(F.lit(names[0]).alias("_table"), SHARD).where(inside)
        else:
            pairs = stored.where(inside).select("_table", SHARD).distinct()
        partly = checkpoint(edges.where(gone).select("_table", SHARD).distinct())
        return _of_shards(edges, partly).where(~gone), checkpoint(pairs.unionByName(partly))

    def _known(self, names) -> dict:
        catalog = self._catalog()
        for name in names:
            if name not in catalog:
                raise AliasNotFound(f"table '{name}' does not exist")
        return catalog

    def read(
        self, tables: list[str] | str, columns=None, ranges=None, *, now: datetime | None = None, decode: bool = True
    ) -> DataFrame:
        """Rows of one or more tables, with ``$table`` if a list is given.

        ``ranges`` lists (begin, end) pairs or is a DataFrame of them, which may be large, in
        microseconds. ``now`` hides rows past the tables' retention. Symbols come as text, or
        without ``decode`` as their numbers.
        """
        single = isinstance(tables, str)
        names = [tables] if single else list(dict.fromkeys(tables))
        catalog = self._known(names)
        if isinstance(ranges, DataFrame):
            shards = self._shards_at(names, catalog, covered_times(ranges))
            rows = in_range_set(self._rows(names, catalog, shards), ranges)
        else:
            ranges = list(ranges or [])
            rows = self._rows(names, catalog, self._shard_filter(names, catalog, ranges))
            if REST in rows.columns:
                rows = in_ranges(rows.withColumn(nanos(TS), F.col(quoted(REST))), ranges).drop(nanos(TS))
            else:
                rows = in_ranges(rows, ranges)
        if now is not None:
            limits = [(n, now - catalog[n][0].ttl) for n in names if catalog[n][0].has_ttl]
            rows = self._above(rows, limits, F.col(quoted(TS)), "timestamp_ntz")
        stored: dict[str, list[str]] = {}
        for name in names:
            for column in catalog[name][0].columns:
                cells = stored.setdefault(column.name, [])
                if (cell := _physical(column)) not in cells:
                    cells.append(cell)
        if decode:
            wanted = set(stored) if not columns or isinstance(columns, str) else set(columns)
            named = {_physical(c): c.symtable for n in names for c in catalog[n][0].columns if c.symtable and c.name in wanted}
            rows = self._decoded(rows, named)
        chosen = {name: [F.col(quoted(cell)) for cell in cells] for name, cells in stored.items()}
        for name, cells in chosen.items():
            if len(cells) > 1:
                kinds = {catalog[t][0].column(name).type for t in names if name in
                         [c.name for c in catalog[t][0].columns]}
                if len({k.spark_type.simpleString() for k in kinds}) > 1:
                    raise InvalidArgument(f"column '{name}' has different types in these tables: read them apart")
        shaped = rows.select(
            quoted(TS),
            F.col("_table").alias(TABLE),
            *[F.coalesce(*cells).alias(name) if len(cells) > 1 else cells[0].alias(name)
              for name, cells in chosen.items()],
        )
        shaped = project(shaped, columns)
        return shaped.drop(TABLE) if single else shaped

    # ------------------------------------------------------------ symbols

    def symbols(self, *symtables: str) -> DataFrame:
        """(symtable, symbol_id, symbol): every symbol that was ever pushed, with its number."""
        found = [c["symbols"]["version"] for c in self._load() if c.get("symbols")]
        if not found:
            return self.spark.createDataFrame([], _SYMBOL_SCHEMA)
        known = self.spark.read.schema(_SYMBOL_SCHEMA).parquet(*[f"{self.root}/symbols/_v={v}" for v in found])
        return known.where(F.col("symtable").isin(list(symtables))) if symtables else known

    def _decoded(self, rows: DataFrame, named: dict[str, str]) -> DataFrame:
        """Symbols of the given stored columns in place of their numbers."""
        for cell, symtable in sorted(named.items()):
            side = self.symbols(symtable).select(F.col("symbol_id").alias("_id"), F.col("symbol").alias("_symbol"))
            rows = rows.join(side, F.col(quoted(cell)) == F.col("_id"), "left").withColumn(cell, F.col("_symbol")).drop("_id", "_symbol")
        return rows

    def _encoded(self, staged: DataFrame, named: dict[str, str]) -> tuple[DataFrame, dict | None]:
        """Numbers in place of symbols, and the growth of the symbol tables to be committed.

        Numbers count up from 0 in each symbol table and never change. New symbols are
        written aside; they exist once the commit that names them does. Another commit that
        comes first makes this one fail, so no number is given twice.
        """
        if not named:
            return staged, None
        used = reduce(DataFrame.unionByName, [
            staged.select(F.lit(table).alias("symtable"), F.col(quoted(cell)).alias("symbol")) for cell, table in named.items()
        ])
        used = used.where("symbol IS NOT NULL").distinct()
        known = self.symbols(*set(named.values()))
        fresh = checkpoint(used.join(known, ["symtable", "symbol"], "left_anti"))
        growth = None
        if not fresh.isEmpty():
            following: dict[str, int] = {}
            for commit in self._load():
                following |= (commit.get("symbols") or {}).get("next", {})
            counted = row_index(fresh, ["symtable", "symbol"], "_n")
            # One row per symbol table of the push.
            begun = [(r.symtable, r.first, r.n) for r in counted.groupBy("symtable").agg(
                F.min("_n").alias("first"), F.count("*").alias("n")).collect()]
            shifts = [(table, following.get(table, 0) - first) for table, first, _ in begun]
            side = F.broadcast(self.spark.createDataFrame(shifts, "symtable string, _shift bigint"))
            version = uuid.uuid4().hex
            counted.join(side, "symtable").select(
                "symtable", (F.col("_n") + F.col("_shift")).alias("symbol_id"), "symbol"
            ).write.parquet(f"{self.root}/symbols/_v={version}")
            growth = {"version": version, "next": {table: following.get(table, 0) + n for table, _, n in begun}}
            known = known.unionByName(self.spark.read.schema(_SYMBOL_SCHEMA).parquet(f"{self.root}/symbols/_v={version}"))
        lost = F.raise_error(F.lit("a symbol has no number")).cast("bigint")
        for cell, symtable in sorted(named.items()):
            side = known.where(F.col("symtable") == symtable).select(F.col("symbol_id").alias("_id"), F.col("symbol").alias("_symbol"))
            number = F.when(F.col(quoted(cell)).isNotNull(), F.coalesce("_id", lost))
            staged = staged.join(side, F.col(quoted(cell)) == F.col("_symbol"), "left").withColumn(cell, number).drop("_id", "_symbol")
        return staged, growth

    def register(self, *tables: str) -> None:
        """Make tables known to ``spark.sql`` under their names (default: all)."""
        for name in tables or self.tables():
            self.read([name]).createOrReplaceTempView(quoted(name))

    # ------------------------------------------------------------ writing

    def _staged(
        self, batch, tables=None, infer: bool = True, force: dict[str, str] | None = None, seq: str | None = None
    ) -> tuple[list[str], DataFrame]:
        """Batch rows in stored form: ``_table``, ``_shard``, physical column names.

        ``batch`` maps table names to frames, is a list of such pairs, or is one frame
        with a ``$table`` column.
        """
        if isinstance(batch, DataFrame):
            return self._staged_rows(batch, tables, infer, force, seq)
        pairs = list(batch.items()) if isinstance(batch, dict) else list(batch)
        frames = dict(pairs)
        if len(frames) != len(pairs):
            raise InvalidArgument("a table may be staged only once per push")
        catalog = self._known(frames)
        staged = None
        for name, df in frames.items():
            named = df.withColumn(TABLE, F.lit(name))
            part = self._stored_columns(named, catalog[name][0], {name: catalog[name][0]}, infer, force, seq)
            staged = part if staged is None else staged.unionByName(part, allowMissingColumns=True)
        if staged is None:
            raise InvalidArgument("nothing to push")
        return list(frames), staged

    def _staged_rows(self, batch, tables, infer, force, seq) -> tuple[list[str], DataFrame]:
        """One frame for any number of tables with the same columns."""
        names = list(tables or self.tables())
        catalog = self._known(names)
        schemas = {n: catalog[n][0] for n in names}
        if len({s.columns for s in schemas.values()}) != 1:
            raise InvalidArgument("tables pushed as one frame need the same columns")
        # A wrong name fails the write itself: no extra pass, and nothing gets published.
        table = F.col(quoted(TABLE))
        wrong = F.raise_error(F.concat(F.lit("no such table in this push: "), F.coalesce(table, F.lit("null"))))
        batch = batch.withColumn(TABLE, F.when(table.isin(names), table).otherwise(wrong.cast("string")))
        return names, self._stored_columns(batch, schemas[names[0]], schemas, infer, force, seq)

    @staticmethod
    def _stored_columns(batch, schema, schemas, infer, force, seq) -> DataFrame:
        extra = (TABLE, seq) if seq else (TABLE,)
        if nanos(TS) in batch.columns and not all(one.fine for one in schemas.values()):
            raise InvalidArgument(f"the batch has times finer than a microsecond: add an int64 column '{nanos(TS)}' to the table")
        clean = W.align(W.cast_to(batch, schema, W.forced_types(force, schema), infer), schema, extra)
        # The index is never null: such a row would lie in no range and no shard.
        missing = F.raise_error(F.lit(f"a row has no {TS}, or one before 1970")).cast("timestamp_ntz")
        clean = clean.withColumn(TS, F.coalesce(F.col(quoted(TS)), missing))
        for column in schema.columns:  # nanoseconds are null only where their time is
            if schema.fine and column.name.endswith(nanos("")) and column.name.removesuffix(nanos("")) in clean.columns:
                time = F.col(quoted(column.name.removesuffix(nanos(""))))
                clean = clean.withColumn(column.name, F.when(time.isNotNull(), F.coalesce(quoted(column.name), F.lit(0))))
        sizes: dict[timedelta, list[str]] = {}
        for name, one in schemas.items():
            sizes.setdefault(one.shard_size, []).append(name)
        us, shard = micros(F.col(quoted(TS))), None
        for size, names in sizes.items():
            number = floor_div(us, size // MICROS)
            shard = number if shard is None else F.when(F.col(quoted(TABLE)).isin(names), number).otherwise(shard)
        return clean.select(
            quoted(TS),
            *([F.col(quoted(seq)).alias("_seq")] if seq else []),
            *[F.col(quoted(c.name)).alias(_physical(c)) for c in schema.columns],
            F.col(quoted(TABLE)).alias("_table"),
            shard.alias(SHARD),
        )

    def _commit(
        self,
        kind: str,
        rows: DataFrame | None,
        batch: DataFrame | None,
        replaced: DataFrame | None,
        batch_id: str | None,
        now: datetime | None,
        based_on: int,
        symbols: dict | None = None,
    ) -> int:
        """Write a version and publish it. ``replaced`` lists obsolete (table, shard)."""
        number = based_on + 1
        version = f"{number}-{uuid.uuid4().hex[:12]}"
        has_rows = False
        if rows is not None:
            # The hash spreads rows of one table that share a time over several tasks.
            salt = F.pmod(F.xxhash64(*[quoted(c) for c in rows.columns]), F.lit(64))
            keys = [SHARD, "_table", quoted(TS), "_salt"]
            target = f"{self.root}/data/_v={version}"
            (
                rows.withColumn("_salt", salt)
                .repartitionByRange(*keys)
                .sortWithinPartitions(*keys)
                .drop("_salt")
                .write.partitionBy(SHARD)
                .parquet(target)
            )
            has_rows = any(s.isDirectory() for s in self._fs.listStatus(self._path(target)))
        if replaced is not None:
            replaced.select("_table", SHARD).distinct().write.parquet(f"{self.root}/replaced/_v={version}")
        if batch is not None:
            # Before the commit: a published version always has its lines, and lines of a
            # version that is never published are not read.
            spans = batch
            if batch is rows:  # a plain push reads the spans back from what it wrote
                stored = T.StructType([f for f in rows.schema.fields if f.name in (TS, "_table")])
                spans = self.spark.read.schema(stored).parquet(f"{self.root}/data/_v={version}")
            self._log_change(number, version, spans, now or utc_now())
        self._publish(
            number,
            {
                "kind": kind,
                "version": version,
                "has_rows": has_rows,
                "replaces": replaced is not None,
                "batch_id": batch_id,
                "symbols": symbols,
                "logged": batch is not None,
                "time": (now or utc_now()).isoformat(sep=" "),
            },
        )
        return number

    def _log_change(self, number: int, version: str, batch: DataFrame, now: datetime) -> None:
        spans = batch.groupBy(F.col("_table").alias("table")).agg(
            F.min(quoted(TS)).alias("begin"), F.max(quoted(TS)).alias("end")
        )
        spans.select(
            timestamp(now).alias("log_ts"), F.lit(number).cast("long").alias("transaction_id"),
            "table", "begin", "end",
        ).write.mode("overwrite").parquet(f"{self.root}/changes/_v={version}")

    def push(
        self,
        batch: DataFrame | dict[str, DataFrame] | list[tuple[str, DataFrame]],
        mode: str = "transactional",
        *,
        tables: list[str] | None = None,
        range=None,
        seq: str | None = None,
        deduplicate=False,
        deduplication_mode: str = "drop",
        batch_id: str | None = None,
        infer_types: bool = True,
        dtype: dict[str, str] | list[str | None] | str | None = None,
        now: datetime | None = None,
    ) -> int:
        """Write batches of one or more tables as one commit; returns its number.

        ``batch`` is one frame with a ``$table`` column (``tables`` limits the names, all
        of the same columns), or frames by table name.

        ``mode``: transactional, fast, async (all append here) or truncate. A batch id
        that was committed before is not written again. ``seq`` names a batch column
        that orders rows with equal deduplication keys.
        """
        if mode not in ("transactional", "fast", "async", "truncate"):
            raise InvalidArgument(f"unknown push mode {mode!r}")
        if range is not None and mode != "truncate":
            raise InvalidArgument("a truncate range needs the push mode 'truncate'")
        if batch_id is not None:
            done = self.committed(batch_id)
            if done is not None:
                return done
        based_on = self._next() - 1
        names, ordered = self._staged(batch, tables, infer_types, dtype, seq if deduplicate else None)
        catalog = self._catalog()
        named = {_physical(c): c.symtable for n in names for c in catalog[n][0].columns if c.symtable}
        if deduplicate or mode == "truncate" or named:
            # The batch is read several times from here on, and must be the same each time.
            ordered = checkpoint(ordered)
        W.check_batch([ordered])
        ordered, symbols = self._encoded(ordered, named)
        staged = ordered.drop("_seq")
        order = "_seq" if "_seq" in ordered.columns else None
        commit = partial(self._commit, batch_id=batch_id, now=now, based_on=based_on, symbols=symbols)
        if mode == "truncate":
            if range is None:
                if len(names) > 1:
                    raise InvalidArgument("truncating several tables needs an explicit range")
                begin, end, rests = self._extent(staged)
            else:
                begin, end = range
                rests = nanosecond(begin), nanosecond(end)
            kept, touched = self._truncated(names, catalog, begin, end, rests, closed=range is None)
            rows = self._stored_form(kept, staged)
            return commit("truncate", rows, staged, touched)
        keys = None
        if deduplicate:
            columns = {c.name for n in names for c in catalog[n][0].columns}
            keys = W.dedup_keys(deduplicate, deduplication_mode, sorted(columns))
            if deduplicate is True:
                keys = [TS, *keys]
        else:
            W.dedup_keys(deduplicate, deduplication_mode, [])
        if keys is None:
            return commit(mode, staged, staged, None)
        physical = ["_table"]
        # A time is equal only if its nanoseconds are.
        keys = list(dict.fromkeys([*keys, *[nanos(k) for k in keys if nanos(k) in columns]]))
        for key in keys:
            physical += [TS] if key == TS else sorted(
                {_physical(c) for n in names for c in catalog[n][0].columns if c.name == key}
            )
        stored = self._rows(names, catalog)
        if REST in physical:  # rows from before the table had nanoseconds
            stored = stored.withColumn(REST, F.coalesce(quoted(REST), F.lit(0)))
        if TS in keys:  # only shards the batch touches can hold an equal key
            stored = _of_shards(stored, checkpoint(staged.select("_table", SHARD).distinct()))
        if deduplication_mode == "drop":
            fresh = W.dedup_new_rows(stored, ordered, physical, order).drop("_seq")
            return commit("dedup_drop", fresh, staged, None)
        asked = checked_broadcast(
            staged.select(*[F.col(quoted(k)).alias(f"_key_{k}") for k in physical]).distinct()
        )
        match = W.same_key(stored, asked, physical)
        # Keys alone are read to find the shards, whole rows from these only.
        touched = checkpoint(stored.join(asked, match, "left_semi").select("_table", SHARD).distinct())
        kept = _of_shards(stored, touched)
        kept = kept.join(asked, W.same_key(kept, asked, physical), "left_anti")
        rows = self._stored_form(kept, W.one_per_key(ordered, physical, order, "last").drop("_seq"))
        return commit("dedup_upsert", rows, staged, touched)

    @staticmethod
    def _stored_form(kept: DataFrame, new: DataFrame) -> DataFrame:
        return kept.drop("_v").unionByName(new, allowMissingColumns=True)

    # ------------------------------------------------------------ upkeep

    def compact(
        self, tables: list[str] | None = None, *, step: int | None = None, progress: Callable[[int, int], bool | None] | None = None
    ) -> int | None:
        """Rewrite the shards that are spread over several versions; rows stay the same.

        ``step`` limits the shard numbers that one commit takes; the default is one commit for
        all. After each commit ``progress`` is told how many shard numbers are done, and of how
        many; if it returns False, compaction ends there, and what is done stays. Versions that
        no row counts of any more are named in the last commit, and readers leave them alone.
        """
        names = list(tables or self.tables())
        catalog = self._known(names)
        spread = checkpoint(
            self._rows(names, catalog).groupBy("_table", SHARD).agg((F.min("_v") != F.max("_v")).alias("_many")).where("_many")
            .select("_table", SHARD)
        )
        parts = cut(covered_numbers(spread, SHARD), step)
        total, done, last = sum(b - a + 1 for part in parts for a, b in part), 0, None
        for part in parts:
            based_on = self._next() - 1
            own = spread.where(within(F.col(SHARD), part))
            rows = _of_shards(self._rows(names, catalog), own).drop("_v")
            last = self._commit("compact", rows, None, own, None, None, based_on)
            done += sum(b - a + 1 for a, b in part)
            if progress is not None and progress(done, total) is False:
                return last
        if last is not None:
            self._retire()
        return last

    def _retire(self) -> None:
        """Name the versions of which no row counts any more."""
        based_on = self._next() - 1
        filled = {c["version"] for c in self._filled()}
        everything = sorted(self._catalog())
        # One short row per version that is read.
        live = {r["_v"] for r in self._rows(everything, self._catalog()).select("_v").distinct().collect()}
        if filled - live:
            self._publish(based_on + 1, {"kind": "retire", "dead": sorted(filled - live)})

    def _filled(self) -> list[dict]:
        """Commits whose rows may count."""
        commits = self._load()
        dead = {v for c in commits for v in c.get("dead") or ()}
        return [c for c in commits if c.get("version") and c["has_rows"] and c["version"] not in dead]

    def expire(self, now: datetime) -> int | None:
        """Retire whole shards that lie past their table's retention."""
        catalog = self._catalog()
        based_on = self._next() - 1
        names = [n for n, (s, _) in catalog.items() if s.has_ttl]
        if not names:
            return None
        epoch = datetime(1970, 1, 1)
        limits = [(n, (now - catalog[n][0].ttl - epoch) // catalog[n][0].shard_size) for n in names]
        side = self.spark.createDataFrame(limits, "_table string, _limit bigint")
        stored = self._rows(names, catalog).select("_table", SHARD).distinct()
        gone = checkpoint(stored.join(F.broadcast(side), "_table").where(F.col(SHARD) < F.col("_limit")).drop("_limit"))
        if gone.isEmpty():
            return None
        return self._commit("expire", None, None, gone, None, now, based_on)

    def _lines(self, versions: list[str]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], _CHANGE_SCHEMA)
        return self.spark.read.schema(_CHANGE_SCHEMA).parquet(*[f"{self.root}/changes/_v={v}" for v in versions])

    def changes(self) -> DataFrame:
        """The change log of published versions; begin and end of a span are both included."""
        return self._lines([c["version"] for c in self._load() if c.get("logged")])

    def commit_stream(self) -> DataFrame:
        """Published commits as a stream; ``changes_of`` turns its batches into log lines."""
        self._fs.mkdirs(self._path(f"{self.root}/log"))
        return self.spark.readStream.schema("number bigint, version string, logged boolean").json(f"{self.root}/log")

    def changes_of(self, commits: DataFrame) -> DataFrame:
        """The change-log lines of some commits."""
        return self._lines([r.version for r in commits.where("logged").select("version").distinct().collect()])
