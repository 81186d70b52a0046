"""Declarative table catalogue: which table owns a field, its type, grain and roll-up.

The layouts themselves are in :mod:`.layouts`.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import types as T

from .grain import Grain
from .layouts import LAYOUTS

SPARK_TYPES = {
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}

ROLLUPS = ("first", "last", "sum", "mean", "avg", "max", "min", "median", "count")

# Seconds for which a loaded row of each kind counts as fresh.
FRESH_SECONDS = {
    "realtime_quotes": 60,
    "daily_historical": 86_400,
    "financial_statements": 604_800,
    "company_profiles": 86_400,
    "key_metrics": 604_800,
    "earnings_calendar": 21_600,
    "sec_filings": 86_400,
    "insider_trades": 3_600,
    "economic_indicators": 86_400,
    "index_constituents": 86_400,
    "static_lists": 2_592_000,
    "analyst": 86_400,
    "senate": 3_600,
    "esg": 604_800,
    "dcf": 86_400,
    "default": 3_600,
}


@dataclass(frozen=True)
class FieldSpec:
    name: str
    source: str
    dtype: str
    rollup: str = "last"

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.dtype]

    def struct_field(self) -> T.StructField:
        return T.StructField(
            self.name, self.spark_type, True, {"source": self.source, "rollup": self.rollup}
        )


@dataclass(frozen=True)
class TableSpec:
    name: str
    grain: Grain
    keys: tuple[str, ...]
    fields: dict[str, FieldSpec] = field(default_factory=dict)
    freshness: str = "default"
    date_source: str = "date"

    @property
    def by_symbol(self) -> bool:
        return "symbol" in self.keys

    @property
    def by_date(self) -> bool:
        return "date" in self.keys

    @property
    def fresh_seconds(self) -> int:
        return FRESH_SECONDS.get(self.freshness, FRESH_SECONDS["default"])

    def key_source(self, key: str) -> str:
        return self.date_source if key == "date" else key

    def key_fields(self) -> list[T.StructField]:
        kinds = {"date": T.DateType()}
        return [
            T.StructField(k, kinds.get(k, T.StringType()), k != "symbol",
                          {"source": self.key_source(k)})
            for k in self.keys
        ]

    def schema(self, versioned: bool = False) -> T.StructType:
        """Storage schema (DDL counterpart); ``versioned`` adds the load columns."""
        cols = self.key_fields() + [f.struct_field() for f in self.fields.values()]
        if versioned:
            cols += VERSION_FIELDS
        return T.StructType(cols)


VERSION_FIELDS = [
    T.StructField("_fetched_at", T.TimestampType(), False),
    T.StructField("_batch_id", T.StringType(), True),
    T.StructField("_seq", T.LongType(), True),
]
VERSION_COLUMNS = [f.name for f in VERSION_FIELDS]


def camel(name: str) -> str:
    """The attribute that a raw payload usually has for a column name."""
    head, *rest = name.split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in rest)


def table(name: str, grain: str, keys: tuple[str, ...], freshness: str, date_source: str, columns: Iterable[tuple]) -> TableSpec:
    """A TableSpec from a written-out layout."""
    return TableSpec(name, Grain[grain], keys, {c[0]: FieldSpec(*c) for c in columns}, freshness, date_source)


# Further names a field may be asked for by.
ALIASES = {
    "pe_ratio": "price_earnings_ratio",
    "quote_pe": "price_earnings_ratio",
    "pb_ratio": "price_to_book",
    "price_to_sales": "price_to_sales_r",
    "debt_to_equity": "debt_equity_ratio",
    "debt_to_assets": "debt_ratio",
    "dividend_yield": "dividend_yield_r",
    "payout_ratio": "dividend_per_share_r",
    "revenue_per_share": "revenue_per_share_r",
    "net_income_per_share": "net_income_per_share_r",
    "book_value_per_share": "book_value_per_share_r",
    "fcf_per_share": "fcf_per_share_r",
    "cash_per_share": "cash_per_share_r",
    "operating_cf_per_share": "operating_cf_per_share_r",
    "shares_outstanding": "outstanding_shares",
    "avg_volume": "quote_volume",
    "quote_eps": "eps",
    "gross_profit_ratio": "gross_profit_margin",
    "operating_income_ratio": "operating_profit_margin",
    "ebitda_ratio": "ebitda_margin_r",
    "net_income_ratio": "net_profit_margin",
}


class Catalog:
    """Tables, the field → table resolution, and aliases; users may add their own."""

    def __init__(self, tables: Iterable[TableSpec] = (), aliases: dict[str, str] | None = None):
        self.tables: dict[str, TableSpec] = {}
        self.owner: dict[str, tuple[str, FieldSpec]] = {}
        self.aliases: dict[str, str] = {}
        for spec in tables:
            self.add(spec)
        for alias, target in (aliases or {}).items():
            self.add_alias(alias, target)

    def add(self, spec: TableSpec) -> "Catalog":
        self.tables[spec.name] = spec
        for f in spec.fields.values():
            self.owner.setdefault(f.name, (spec.name, f))
        return self

    def add_alias(self, alias: str, target: str) -> "Catalog":
        if target not in self.owner:
            raise ValueError(f"alias {alias!r} points at unknown field {target!r}")
        self.aliases[alias] = target
        return self

    def __getitem__(self, name: str) -> TableSpec:
        try:
            return self.tables[name]
        except KeyError:
            raise ValueError(f"unknown table {name!r}") from None

    def __contains__(self, field_name: str) -> bool:
        return field_name in self.owner or field_name in self.aliases

    def resolve(self, field_name: str) -> tuple[str, FieldSpec]:
        """Owning table and spec of a field or alias."""
        name = self.aliases.get(field_name, field_name)
        try:
            return self.owner[name]
        except KeyError:
            raise ValueError(f"unknown field {field_name!r}") from None

    def field_names(self, table_name: str | None = None) -> list[str]:
        if table_name is None:
            return sorted(self.owner)
        return sorted(self[table_name].fields)


def default_catalog() -> Catalog:
    return Catalog((table(*layout) for layout in LAYOUTS), ALIASES)
