"""Newest versions in Spark's own bucketed tables, from which panels are read without a shuffle.

A store appends by load; every query then chooses versions and brings symbols together.  Here both
are done once: :meth:`BucketedStore.publish` writes a table's newest rows dealt by a hash of the
symbol, in key order, a file per year and bucket, and :meth:`BucketedStore.refresh` rewrites the
years that later loads touched.  Scans of tables with equal bucket counts are co-located, so the
as-of carry, windows, seeds and joins on the symbol need no exchange.

Joins on (symbol, date) between daily tables keep the buckets where the session sets
``spark.sql.requireAllClusterKeysForCoPartition`` to false; by default Spark shuffles those.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import versions as V
from .catalog import Catalog, TableSpec
from .store import Source, VersionedStore, YearFolders

YEAR = "date_year"


class BucketedStore(YearFolders):
    """One folder per table, ``root/buckets-<n>/<table>``, unique per table key, without version columns.

    ``buckets`` is the number of tasks that read a table: choose it so that one bucket of all the
    years a query reads fits a task, and equal for all tables that are read together.  A symbol's
    rows share a bucket, which the calendar bounds, since rows are unique per key; tables whose keys
    hold several rows (events) stay in the versioned store, as do tables without a symbol.

    Defined results: a table that was not published raises; an empty one has no rows; rows without
    a date have a year folder of their own; a publication replaces the earlier one, and sessions see
    those of others in a store opened afterwards.  One writer at a time and no reader of the years
    that are rewritten; a write that failed is run again.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 256, catalog: Catalog | None = None):
        super().__init__(catalog)
        if buckets < 1:
            raise ValueError("a table needs at least one bucket")
        self.spark = spark
        self.root = f"{root.rstrip('/')}/buckets-{buckets}"
        self.buckets = buckets
        self._space = f"panel_{uuid.uuid5(uuid.NAMESPACE_URL, self.root).hex}"
        self._open: set[str] = set()

    # -- layout ------------------------------------------------------------
    def _spec(self, table: str) -> TableSpec:
        spec = self.catalog[table]
        if not spec.by_symbol:
            raise ValueError(f"{table} has no symbol to be bucketed by")
        return spec

    def _name(self, table: str) -> str:
        return f"{self._space}_{table}"

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _exists(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _schema(self, spec: TableSpec) -> T.StructType:
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in spec.schema()])
        return schema.add(YEAR, T.IntegerType()) if spec.by_date else schema

    def _attach(self, table: str) -> str:
        """The name under which this session's catalogue knows the folder; its years are listed once per store."""
        spec, name = self._spec(table), self._name(table)
        if table in self._open:
            return name
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._schema(spec))
            keys = ", ".join(f"`{k}`" for k in spec.keys)
            by_year = f"PARTITIONED BY ({YEAR})" if spec.by_date else ""
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by_year} CLUSTERED BY (symbol) "
                           f"SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self._path(table)}'")
        if spec.by_date and self._exists(table):
            self.spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        self._open.add(table)
        return name

    @contextmanager
    def _replacing(self, mode: str):
        """Whether an overwrite replaces the years it holds (``dynamic``) or all of them (``static``)."""
        key = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, mode)
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def _write(self, rows: DataFrame, spec: TableSpec, mode: str) -> None:
        """A task per bucket, as Spark hashes both alike, so that a year has one file a bucket."""
        schema = self._schema(spec)
        if spec.by_date:
            rows = rows.withColumn(YEAR, F.year("date"))
        order = [*([YEAR] if spec.by_date else []), *spec.keys]
        dealt = rows.repartition(self.buckets, "symbol").sortWithinPartitions(*order)
        with self._replacing(mode):
            dealt.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.insertInto(
                self._attach(spec.name), overwrite=True)

    # -- writes ------------------------------------------------------------
    def publish(self, table: str, source: Source) -> None:
        """The newest row of every key of ``source``'s table."""
        spec = self._spec(table)
        self._write(source.scan(table), spec, "static")

    def refresh(self, table: str, source: VersionedStore, since: datetime | str) -> list[int | None]:
        """Rewrite the years that ``source`` got rows of after ``since``; returns them.

        Only the years come to the driver.  A table without dates is rewritten whole.
        """
        spec = self._spec(table)
        if not self.holds(table):
            raise ValueError(f"{table} was not published")
        if not spec.by_date:
            self.publish(table, source)
            return []
        new = source.frame(table).where(F.col(V.FETCHED_AT) > F.lit(since).cast("timestamp"))
        years = sorted((r[0] for r in new.select(F.year("date")).distinct().collect()), key=lambda y: (y is not None, y or 0))
        if years:
            self._write(source.scan(table, where=_in_years(years)), spec, "dynamic")
        return years

    # -- reads -------------------------------------------------------------
    def holds(self, table: str) -> bool:
        return self.catalog[table].by_symbol and self._exists(table)

    def versioned(self, table: str) -> bool:
        return False

    def frame(self, table: str) -> DataFrame:
        """The published rows.

        The key gets metadata of its own: Spark compares the hash partitionings below a union by
        attribute, and finds those of plain table columns unequal once columns are projected.
        """
        self._spec(table)
        if not self.holds(table):
            raise ValueError(f"{table} was not published")
        stored = self.spark.table(self._attach(table))
        key = F.col("symbol").alias("symbol", metadata={"buckets": self.buckets})
        return stored.select(key, *[c for c in stored.columns if c != "symbol"])


def _in_years(years: Sequence[int | None]) -> Column:
    """Rows of the given years, as ranges of ``date`` that prune files and folders."""
    out = F.col("date").isNull() if None in years else F.lit(False)
    for year in (y for y in years if y is not None):
        out = out | F.col("date").between(F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year), F.lit(12), F.lit(31)))
    return out
