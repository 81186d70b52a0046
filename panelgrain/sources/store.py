"""Append-only versioned tables on parquet, and the sources a query can read from."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import date, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import versions as V
from .catalog import Catalog, TableSpec, default_catalog
from .landing import conform, stamp_version


def only_symbols(df: DataFrame, symbols: Sequence[str] | DataFrame | None) -> DataFrame:
    """Keep the given symbols; ``None`` keeps all (Q01).

    A list, of whatever length, is joined, and the range it spans is a filter that reaches
    the scan, where files in key order let it prune.
    """
    if symbols is None or "symbol" not in df.columns:
        return df
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    names = sorted({s for s in symbols if s is not None})
    if not names:
        return df.filter(F.lit(False))
    spanned = df.filter(F.col("symbol").between(names[0], names[-1]))
    if names[0] == names[-1]:
        return spanned  # the range is the list
    wanted = df.sparkSession.createDataFrame(pa.table({"symbol": pa.array(names, pa.string())}))
    return spanned.join(wanted, "symbol", "left_semi")


def in_range(df: DataFrame, start: date | str | None, end: date | str | None) -> DataFrame:
    """Inclusive on both ends (Q03)."""
    if "date" not in df.columns:
        return df
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("date") <= F.lit(end).cast("date"))
    return df


class Source:
    """Where a query gets its tables.  Subclasses supply :meth:`frame`."""

    catalog: Catalog

    def frame(self, table: str) -> DataFrame:
        """All stored rows of a table, old versions included where there are any."""
        raise NotImplementedError

    def same_rows(self, table: str, other: str) -> bool:
        """Whether two tables of one grain are stored as one frame and can be read together."""
        return table == other

    def holds(self, table: str) -> bool:
        """Whether the source has the table, be it empty."""
        return True

    def versioned(self, table: str) -> bool:
        return V.FETCHED_AT in self.frame(table).columns

    def scan(
        self,
        table: str,
        columns: Iterable[str] | None = None,
        symbols: Sequence[str] | DataFrame | None = None,
        start: date | str | None = None,
        end: date | str | None = None,
        version_as_of: datetime | str | None = None,
        where: Column | None = None,
        collapse: Sequence[str] = (),
        prefer: Sequence[Column] = (),
        whole_loads: bool = False,
    ) -> DataFrame:
        """Newest version of each key, projected and filtered.

        Filters (``where`` included) are on key columns, so they commute with the
        version choice and Catalyst pushes them and the projection down to the scan.
        ``collapse`` makes rows unique on those keys instead of the table's own,
        taking the first by ``prefer`` and then the newest, in one shuffle.
        ``whole_loads`` keeps every row that a key's newest load brought (event tables).
        """
        spec = self.catalog[table]
        keys = list(spec.keys)
        wanted = list(spec.fields) if columns is None else [c for c in columns if c not in keys]
        df = self.frame(table)
        present = [c for c in keys + wanted if c in df.columns]
        absent = [c for c in keys + wanted if c not in df.columns]
        versioned = V.FETCHED_AT in df.columns
        stamps = [c for c in (V.FETCHED_AT, V.BATCH, V.SEQ) if c in df.columns]
        df = df.select(*present, *stamps)
        df = in_range(only_symbols(df, symbols), start, end)
        if where is not None:
            df = df.filter(where)
        if whole_loads:
            if versioned:
                df = V.newest_load(df, [k for k in keys if k in df.columns], version_as_of)
        elif versioned or collapse:
            live_keys = [k for k in collapse or keys if k in df.columns]
            if versioned and version_as_of is not None:
                df = V.as_of_version(df, live_keys, version_as_of, prefer=prefer)
            else:
                df = V.latest(df, live_keys, prefer=prefer)
        types = {f.name: f.dataType for f in spec.key_fields()}
        types.update({c: self.catalog.resolve(c)[1].spark_type for c in wanted})
        empty = [F.lit(None).cast(types[c]).alias(c) for c in absent]
        return df.select(*present, *empty).select(*keys, *wanted)

    def seeds(
        self,
        table: str,
        columns: Sequence[str],
        day: date | str,
        symbols: Sequence[str] | DataFrame | None = None,
        version_as_of: datetime | str | None = None,
        where: Column | None = None,
        prefer: Sequence[Column] = (),
    ) -> DataFrame:
        """One row per symbol: its last one before ``day``, from which a carry can start.

        ``prefer``: columns whose greatest value wins among rows of one date.
        """
        spec = self.catalog[table]
        df = self.until(table, day)
        present = [c for c in columns if c in df.columns]
        stamps = [c for c in (V.FETCHED_AT, V.BATCH, V.SEQ) if c in df.columns]
        keys = [k for k in spec.keys if k in df.columns]
        df = only_symbols(df.select(*keys, *[c for c in present if c not in keys], *stamps), symbols)
        if where is not None:
            df = df.filter(where)
        if version_as_of is not None and V.FETCHED_AT in stamps:
            df = df.filter(F.col(V.FETCHED_AT) <= F.lit(version_as_of).cast("timestamp"))
        df = V.newest_before(df, day, prefer=prefer)
        empty = [F.lit(None).cast(self.catalog.resolve(c)[1].spark_type).alias(c) for c in columns if c not in present]
        return df.select("symbol", "date", *present, *empty).select("symbol", "date", *columns)

    def until(self, table: str, day: date | str) -> DataFrame:
        """At least all stored rows before ``day``."""
        return self.frame(table)

    def read(self, table: str, symbols=None, start=None, end=None, columns=None) -> DataFrame:
        """Latest-version scan ordered by key."""
        spec = self.catalog[table]
        return self.scan(table, columns, symbols, start, end).orderBy(*spec.keys)

    def read_source_names(self, table: str, symbols=None, start=None, end=None) -> DataFrame:
        """Latest-version scan under the raw attribute names."""
        spec = self.catalog[table]
        rows = self.read(table, symbols, start, end)
        # Two columns may come from one attribute; the later one wins, as in a dict.
        names = {f.source: f.name for f in spec.fields.values()}
        return rows.select(
            *spec.keys, *[F.col(n).alias(src) for src, n in names.items() if src not in spec.keys]
        )

    def create_views(self, spark: SparkSession, tables: Iterable[str] | None = None) -> None:
        """Latest-version scans as temp views, for ad-hoc SQL."""
        for name in tables if tables is not None else self.catalog.tables:
            self.scan(name).createOrReplaceTempView(name)


Given = DataFrame | Callable[[], DataFrame]


class FrameSource(Source):
    """Tables given as DataFrames, or as functions that make one when first needed.

    A frame without version columns must be unique per table key.  Tables given
    the *same* object are columns of one wide table: a query scans it once instead
    of joining it with itself.
    """

    def __init__(self, frames: dict[str, Given], catalog: Catalog | None = None):
        self.catalog = catalog or default_catalog()
        self.frames = dict(frames)
        self._made: dict[int, DataFrame] = {}
        for name in self.frames:
            self.catalog[name]

    def frame(self, table: str) -> DataFrame:
        try:
            given = self.frames[table]
        except KeyError:
            raise ValueError(f"no data given for table {table!r}") from None
        if isinstance(given, DataFrame):
            return given
        if id(given) not in self._made:
            self._made[id(given)] = given()
        return self._made[id(given)]

    def holds(self, table: str) -> bool:
        return table in self.frames

    def same_rows(self, table: str, other: str) -> bool:
        if table == other:
            return True
        a, b = self.frames.get(table), self.frames.get(other)
        return a is not None and a is b and self.catalog[table].grain is self.catalog[other].grain


class YearFolders(Source):
    """A source whose dated tables have a column ``date_year`` that stands for folders: bounds on dates prune them."""

    def __init__(self, catalog: Catalog | None = None):
        self.catalog = catalog or default_catalog()

    def until(self, table: str, day: date | str) -> DataFrame:
        df = self.frame(table)
        if not self.catalog[table].by_date:
            return df
        return df.filter(F.col("date_year") <= F.year(F.lit(day).cast("date"))).drop("date_year")

    def scan(self, table, columns=None, symbols=None, start=None, end=None, version_as_of=None, **kw):
        spec = self.catalog[table]
        if not (spec.by_date and (start is not None or end is not None)):
            return super().scan(table, columns, symbols, start, end, version_as_of, **kw)
        pruned = self.frame(table)
        if start is not None:
            pruned = pruned.filter(F.col("date_year") >= F.year(F.lit(start).cast("date")))
        if end is not None:
            pruned = pruned.filter(F.col("date_year") <= F.year(F.lit(end).cast("date")))
        return FrameSource({table: pruned}, self.catalog).scan(
            table, columns, symbols, start, end, version_as_of, **kw
        )


class VersionedStore(YearFolders):
    """One directory per table, ``root/<table>/load=<id>/``, of append-only parquet.

    Date-keyed tables are partitioned by ``date_year`` below that, so that date filters prune
    directories; files are sorted by key, so that their statistics prune symbols.  Appended rows are
    the load ``rows``; each batch of a stream is a load of its own, which a replay overwrites.  A
    compaction rewrites the years that hold surplus versions into ``rows`` by dynamic partition
    overwrite and leaves the files of all other years alone (a table without dates is one part); it
    notes which batches it took in, year by year, and a later replay of those adds nothing.  One writer per table at a time, and no reader of the
    years that are rewritten; a compaction that failed is run again before the table is read.
    """

    ROWS = "rows"
    TAKEN = "_taken"

    def __init__(self, spark: SparkSession, root: str, catalog: Catalog | None = None):
        super().__init__(catalog)
        self.spark = spark
        self.root = root.rstrip("/")

    # -- layout ------------------------------------------------------------
    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        p = hadoop.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        p, fs = self._fs(path)
        return fs.exists(p)

    def path(self, table: str) -> str | None:
        """The table's folder, if it has one."""
        path = f"{self.root}/{table}"
        return path if self._exists(path) else None

    def _write(self, df: DataFrame, spec: TableSpec, load: str, mode: str) -> None:
        """``overwrite`` replaces, of a date-keyed table, the load's years that ``df`` holds and no others."""
        partition = []
        if spec.by_date:
            partition = ["date_year"]
            # Few files per year; AQE splits a year that holds most of the rows.
            df = df.withColumn("date_year", F.year("date")).hint("rebalance", "date_year")
        # Within its files a table is in key order (after the directory): two symbols read few row groups.
        order = [*partition, *[k for k in spec.keys if k in df.columns]]
        if order:
            df = df.sortWithinPartitions(*order)
        writer = df.write.mode(mode)
        if partition:
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition)
        writer.parquet(f"{self.root}/{spec.name}/load={load}")

    # -- writes ------------------------------------------------------------
    def create(self, table: str) -> None:
        """An empty typed table."""
        spec = self.catalog[table]
        if self.path(table) is None:
            self._write(self.spark.createDataFrame([], spec.schema(versioned=True)), spec, self.ROWS, "append")

    def append(
        self,
        table: str,
        rows: DataFrame,
        fetched_at: datetime | str | None = None,
        batch_id: str | int = "0",
    ) -> None:
        """Append raw rows (source attribute names) as new versions."""
        spec = self.catalog[table]
        self.append_conformed(table, conform(rows, spec), fetched_at, batch_id)

    def append_conformed(
        self,
        table: str,
        rows: DataFrame,
        fetched_at: datetime | str | None = None,
        batch_id: str | int = "0",
    ) -> None:
        """Append rows that already have the stored column names."""
        spec = self.catalog[table]
        names = spec.schema(versioned=True).fieldNames()
        self._write(stamp_version(rows, fetched_at, batch_id).select(*names), spec, self.ROWS, "append")

    def put_batch(self, table: str, rows: DataFrame, stream: str, batch_id: str) -> None:
        """Write a stream's batch of stored column names; the same batch again takes the place of the first.

        Rows of years in which a compaction has taken the batch in are left out.
        """
        spec = self.catalog[table]
        load = f"batch-{stream}.{batch_id}"
        names = spec.schema(versioned=True).fieldNames()
        stamped = stamp_version(rows, None, batch_id).select(*names)
        if self._exists(f"{self.root}/{table}/{self.TAKEN}"):
            taken = self.spark.read.parquet(f"{self.root}/{table}/{self.TAKEN}").where(F.col("load") == load).distinct()
            year = F.year("date") if spec.by_date else F.lit(None).cast("int")
            stamped = stamped.join(taken, year.eqNullSafe(taken["taken_year"]), "left_anti")
        self._write(stamped, spec, load, "overwrite")

    def compact(self, table: str, keep: int = 1) -> int:
        """Keep the newest ``keep`` versions per key; returns rows deleted.

        A partial aggregate finds the years with surplus versions; these alone are rewritten.
        """
        spec = self.catalog[table]
        if self.path(table) is None:
            return 0
        stored = self._stored(table)
        year = F.col("date_year") if spec.by_date else F.lit(None).cast("int")
        per_key = stored.groupBy(year.alias("year"), *spec.keys).agg(F.count(F.lit(1)).alias("n"))
        surplus = dict(per_key.where(F.col("n") > keep).groupBy("year").agg(F.sum(F.col("n") - keep)).collect())
        if not surplus:
            return 0
        full = [y for y in surplus if y is not None]
        touched = stored.where(year.isin(full) | (year.isNull() if None in surplus else F.lit(False)))
        loads = touched.where(~F.col("load").startswith(self.ROWS)).select("load", year.alias("taken_year")).distinct()
        taken = [(r["load"], r["taken_year"]) for r in loads.collect()]  # folders, which Spark lists on the driver too
        if taken:
            notes = self.spark.createDataFrame(taken, "load string, taken_year int")
            notes.write.mode("append").parquet(f"{self.root}/{table}/{self.TAKEN}")
        names = spec.schema(versioned=True).fieldNames()
        kept = V.keep_newest(touched, spec.keys, keep).select(*names)
        if spec.by_date:
            self._write(kept, spec, self.ROWS, "overwrite")
            gone = [f"load={x}/date_year={'__HIVE_DEFAULT_PARTITION__' if y is None else y}" for x, y in taken]
        else:  # a single part, which is not overwritten while it is read
            gone = [f"load={r['load']}" for r in stored.select("load").distinct().collect()]
            self._write(kept, spec, f"{self.ROWS}-{uuid.uuid4().hex}", "overwrite")
        for part in gone:
            folder, fs = self._fs(f"{self.root}/{table}/{part}")
            fs.delete(folder, True)
        return int(sum(surplus.values()))

    # -- reads -------------------------------------------------------------
    def _stored(self, table: str) -> DataFrame:
        spec = self.catalog[table]
        schema = spec.schema(versioned=True).add("load", T.StringType())
        # The stored year is kept in the read schema so that filters on date can
        # be turned into directory pruning by scan below.
        if spec.by_date:
            schema = schema.add("date_year", T.IntegerType())
        path = self.path(table)
        if path is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def frame(self, table: str) -> DataFrame:
        return self._stored(table).drop("load")

    def revisions(self, table: str, symbol: str | None = None, **equals) -> DataFrame:
        return V.revisions(self.frame(table).drop("date_year"), symbol, **equals)

    def freshness(self, table: str, ttl_seconds: int | None = None, now=None) -> DataFrame:
        spec = self.catalog[table]
        ttl = spec.fresh_seconds if ttl_seconds is None else ttl_seconds
        return V.freshness(self.frame(table), ttl, now, by_symbol=spec.by_symbol)

    def coverage(self, table: str, start=None, end=None) -> DataFrame:
        return V.coverage(self.frame(table), start, end)

    def coverage_gaps(self, table: str, calendar: DataFrame, symbols: DataFrame | None = None) -> DataFrame:
        return V.coverage_gaps(self.frame(table), calendar, symbols)

    def years_covered(self, table: str) -> DataFrame:
        return V.years_covered(self.frame(table))

    def symbols_with_data(self, table: str) -> DataFrame:
        if not self.catalog[table].by_symbol:
            return self.spark.createDataFrame([], "symbol string")
        return V.symbols_with_data(self.frame(table))

    def row_count(self, table: str) -> int:
        return self.frame(table).count()

    def sql(self, query: str, args: dict | None = None) -> DataFrame:
        """Ad-hoc SQL over the latest-version views."""
        stored = [t for t in self.catalog.tables if self.path(t)]
        self.create_views(self.spark, stored)
        return self.spark.sql(query, args=args or {})
