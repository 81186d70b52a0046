"""Landing layer: raw CSV/JSON payloads into typed, versioned rows.

Every function is a plan over whole file sets; nothing is parsed on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .catalog import TableSpec

CORRUPT = "_corrupt_record"

# CSV tokens that stand for "no value".
NULL_TOKENS = ["", "None", "Infinity", "-Infinity", "NaN", "nan", "inf", "-inf"]

# Raw attributes that occur under a second, misspelt name.
ALTERNATIVE_SOURCES = {"acquisitionOrDisposition": "acquistionOrDisposition"}


def clean_token(value: Column) -> Column:
    """NULL for every token that means "no value", the trimmed text otherwise."""
    text = F.trim(value)
    return F.when(~text.isin(NULL_TOKENS), text)


def parse_as(value: Column, dtype: T.DataType) -> Column:
    """Text to a stored type; what does not parse becomes NULL instead of failing the job."""
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        # Whole numbers may be written with a decimal point; fractions are rounded.
        return F.coalesce(value.try_cast(dtype), F.rint(value.try_cast("double")).try_cast(dtype))
    return value.try_cast(dtype)


def read_csv(spark: SparkSession, paths: str | Sequence[str], spec: TableSpec) -> DataFrame:
    """CSV files of one table: cleaned tokens, registry types, source attribute names.

    All files must have the same header; files that order or name columns otherwise raise when read.
    """
    header = spark.read.option("header", True).csv(paths).schema
    raw = spark.read.option("header", True).option("enforceSchema", False).schema(header).csv(paths)
    types = {f.source: f.spark_type for f in spec.fields.values()}
    types[spec.date_source] = T.DateType()
    return raw.select(
        *[parse_as(clean_token(F.col(f"`{c}`")), types.get(c, T.StringType())).alias(c)
          for c in raw.columns]
    )


def read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    spec: TableSpec,
    error_field: str = "Error Message",
) -> DataFrame:
    """JSON payloads: a list or a single object per file both become rows.

    Payloads holding ``error_field``, and files that are no JSON, raise when the rows are consumed.
    """
    schema = payload_schema(spec)
    for extra in ("symbol", error_field):
        if extra not in schema.fieldNames():
            schema = schema.add(extra, T.StringType())
    wanted = schema.fieldNames()
    df = (spark.read.schema(schema.add(CORRUPT, T.StringType())).option("multiLine", True)
          .option("columnNameOfCorruptRecord", CORRUPT).json(paths))
    empty = reduce(and_, [F.col(f"`{c}`").isNull() for c in wanted])
    df = df.filter(F.when(F.col(CORRUPT).isNotNull() & empty,
                          F.raise_error(F.concat(F.lit("no JSON: "), F.left(F.col(CORRUPT), F.lit(200)))).isNull()).otherwise(True))
    return check_errors(df.select(*[f"`{c}`" for c in wanted]), error_field)


def check_errors(df: DataFrame, error_field: str) -> DataFrame:
    err = F.col(f"`{error_field}`")
    return df.filter(
        F.when(err.isNotNull(), F.raise_error(F.concat(F.lit("payload error: "), err)).isNull())
        .otherwise(True)
    ).drop(error_field)


def payload_schema(spec: TableSpec) -> T.StructType:
    """Raw attribute names with stored types; date attributes stay text until conformed."""
    out, seen = T.StructType(), set()
    pairs = [(spec.key_source(k.name), T.StringType()) for k in spec.key_fields()]
    for f in spec.fields.values():
        dtype = T.StringType() if isinstance(f.spark_type, T.DateType) else f.spark_type
        pairs.append((f.source, dtype))
        if f.source in ALTERNATIVE_SOURCES:
            pairs.append((ALTERNATIVE_SOURCES[f.source], dtype))
    for name, dtype in pairs:
        if name not in seen:
            seen.add(name)
            out = out.add(name, dtype)
    return out


def parse_payload(raw: DataFrame, column: str, spec: TableSpec) -> DataFrame:
    """Raw response table: one JSON array (or object) per row, exploded to rows."""
    body = F.col(column)
    as_list = F.when(F.ltrim(body).startswith("["), body).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    rows = F.from_json(as_list, T.ArrayType(payload_schema(spec)))
    carry = [c for c in raw.columns if c != column]
    rows = F.when((F.trim(body) == "") | (body.isNotNull() & rows.isNull()), F.raise_error(F.concat(F.lit("no JSON: "), body))).otherwise(rows)
    return raw.select(*carry, F.explode(rows).alias("__row")).select(*carry, "__row.*")


def stamp_symbol(df: DataFrame, requested: str = "_requested_symbol") -> DataFrame:
    """Fill a missing symbol with the one the payload was requested for."""
    if "symbol" not in df.columns:
        return df.withColumn("symbol", F.col(requested))
    return df.withColumn("symbol", F.coalesce("symbol", requested))


def conform(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Source attributes to stored columns.

    Unknown attributes are dropped, missing ones become NULL, rows of
    symbol-keyed tables without a symbol are dropped, empty dates become NULL.
    """
    have = set(raw.columns)

    def pick(source: str, dtype: T.DataType) -> Column:
        names = [n for n in (source, ALTERNATIVE_SOURCES.get(source)) if n in have]
        if not names:
            return F.lit(None).cast(dtype)
        value = F.coalesce(*[F.col(f"`{n}`") for n in names])
        fractional = (T.DoubleType, T.FloatType, T.DecimalType)
        if isinstance(dtype, (T.LongType, T.IntegerType)) and isinstance(
            raw.schema[names[0]].dataType, fractional
        ):
            value = F.rint(value)  # a bare cast would cut the fraction off
        if isinstance(dtype, T.DateType):
            value = F.to_date(F.nullif(value.cast("string").substr(1, 10), F.lit("")))
        return value.cast(dtype)

    cols = [pick(f.metadata["source"], f.dataType).alias(f.name) for f in spec.schema()]
    out = raw.select(*cols, *[c for c in raw.columns if c in ("_fetched_at", "_batch_id", "_seq")])
    if spec.by_symbol:
        out = out.filter(F.col("symbol").isNotNull() & (F.col("symbol") != ""))
    return out


def stamp_version(
    df: DataFrame, fetched_at: datetime | str | None = None, batch_id: str | int = "0"
) -> DataFrame:
    """Add the load columns unless the rows bring their own."""
    when = F.current_timestamp() if fetched_at is None else F.lit(fetched_at).cast("timestamp")
    if "_fetched_at" not in df.columns:
        df = df.withColumn("_fetched_at", when)
    if "_batch_id" not in df.columns:
        df = df.withColumn("_batch_id", F.lit(str(batch_id)))
    if "_seq" not in df.columns:
        df = df.withColumn("_seq", F.monotonically_increasing_id())
    return df.withColumn("_seq", F.col("_seq").cast("bigint"))


def response_key(endpoint: Column, params: Column) -> Column:
    """Cache key of a raw response: endpoint and parameters in canonical order."""
    ordered = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(params))))
    return F.sha2(F.concat_ws("?", endpoint, ordered), 256)


def unexpired(
    responses: DataFrame, now: datetime | str | None = None, keys: Iterable[str] = ("cache_key",)
) -> DataFrame:
    """Newest response per key that is still within its TTL."""
    from ..operators.versions import latest

    now = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    # Responses of one instant are told apart by the rest of their columns.
    rest = tuple(f.name for f in responses.schema if f.name not in ("fetched_at", *keys) and not isinstance(f.dataType, T.MapType))
    newest = latest(responses, list(keys), fetched_at="fetched_at", seq=rest)
    return newest.filter(
        F.col("fetched_at") + F.make_dt_interval(secs=F.col("ttl_seconds")) > now
    )
