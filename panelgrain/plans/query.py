"""The fluent panel query: fields × symbols × dates × grain → one lazy DataFrame.

Everything here is driver-side bookkeeping over the catalogue; the result is a
single DataFrame plan that Catalyst optimises as a whole.  Shape of the plan:

    scan+newest version  →  roll-up (finer tables)      \\
    scan+newest version  →  exact / period join          > one spine, unique per (symbol, date)
    scan+newest version  →  as-of carry (coarser tables) /
        →  snapshot join  →  window features  →  row features  →  panel features
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.context import FeatureSet
from ..functions.features import default_registry
from ..functions.registry import FeatureRegistry
from ..operators import signals as S
from ..operators.align import join_exact, join_period, join_snapshot
from ..operators.asof import carry_forward
from ..operators.rollup import roll_up
from ..operators.versions import descending
from ..sources.catalog import ROLLUPS, TableSpec
from ..sources.grain import Grain
from ..sources.store import Source, in_range

BENCHMARK = "^GSPC"
_EVERYTHING = object()
#: Stored tables behind the recent-event signals: table, columns and the names the signals know them by.
EVENTS = {
    "insider_events": ("insider_trades", {}, S.insider_signals),
    "senate_events": ("senate_trades", {"senate_trade_type": "type"}, S.senate_signals),
    "grade_events": ("grade_changes", {"grade_action": "action"}, S.grade_signals),
}


class PanelQuery:
    def __init__(self, source: Source, registry: FeatureRegistry | None = None):
        self.source = source
        self.catalog = source.catalog
        self.registry = registry or default_registry()
        self._symbols: list[str] | DataFrame | object | None = None
        self._fields: dict[str, None] = {}
        self._start = self._end = None
        self._grain: Grain | None = None
        self._rollups: dict[str, str] = {}
        self._spine: str | None = None
        self._carry = "left"
        self._period: str | None = None
        self._native = False
        self._warm_up = False
        self._warm_days: int | None = None
        self._calendar_lags = False
        self._inputs: dict[str, DataFrame] = {}
        self._keep_inputs = False
        self._trailing = False
        self._as_of = None
        self._version_as_of = None
        self._benchmark = BENCHMARK

    # -- what to read ------------------------------------------------------
    def symbols(self, *symbols: str | Sequence[str] | DataFrame) -> "PanelQuery":
        """Symbols, lists of them, or one DataFrame with a ``symbol`` column; accumulates."""
        for item in symbols:
            if isinstance(item, DataFrame):
                self._symbols = item
                continue
            if not isinstance(self._symbols, list):
                self._symbols = []
            self._symbols += [item] if isinstance(item, str) else list(item)
        return self

    def all_symbols(self) -> "PanelQuery":
        self._symbols = _EVERYTHING
        return self

    def select(self, *fields: str | Sequence[str]) -> "PanelQuery":
        """Stored fields, aliases or features; accumulates, duplicates count once."""
        for item in fields:
            for name in [item] if isinstance(item, str) else item:
                self._fields[name] = None
        return self

    def date_range(self, start: date | str | None = None, end: date | str | None = None) -> "PanelQuery":
        """Inclusive on both ends."""
        self._start, self._end = start, end
        return self

    def grain(self, grain: Grain | str) -> "PanelQuery":
        self._grain = Grain.parse(grain)
        return self

    def agg(self, **rollups: str) -> "PanelQuery":
        """Roll-up to use for a field instead of its default."""
        for field_name, how in rollups.items():
            if how not in ROLLUPS:
                raise ValueError(f"unknown roll-up {how!r} for {field_name!r}")
            self._rollups[field_name] = how
        return self

    # -- how to align ------------------------------------------------------
    def spine(self, table: str) -> "PanelQuery":
        """Table whose rows the result has; by default the first fine enough one."""
        self.catalog[table]
        self._spine = table
        return self

    def carry(self, how: str) -> "PanelQuery":
        """``left`` keeps rows before the first coarse row, ``inner`` drops them."""
        if how not in ("left", "inner"):
            raise ValueError(f"carry must be 'left' or 'inner', not {how!r}")
        self._carry = how
        return self

    def period(self, kind: str) -> "PanelQuery":
        """Only ``quarter`` or only ``annual`` statement rows."""
        if kind not in ("quarter", "annual"):
            raise ValueError(f"period must be 'quarter' or 'annual', not {kind!r}")
        self._period = kind
        return self

    def native(self) -> "PanelQuery":
        """Evaluate features of coarse tables at their own grain, then align the results."""
        self._native = True
        return self

    def warm_up(self, days: int | None = None) -> "PanelQuery":
        """Let lags and rolling frames see rows before the start date: all of them, or those of
        so many days before it, which lets the scan prune older files."""
        self._warm_up, self._warm_days = True, days
        return self

    def _first_day(self) -> date | str | None:
        """The first day that is read."""
        if not self._warm_up or self._start is None:
            return self._start
        return None if self._warm_days is None else _as_date(self._start) - timedelta(self._warm_days)

    def lag_by(self, kind: str) -> "PanelQuery":
        """``rows`` (default), or ``calendar``: a lag of k means k years, from monthly grain up."""
        if kind not in ("rows", "calendar"):
            raise ValueError(f"lag_by must be 'rows' or 'calendar', not {kind!r}")
        self._calendar_lags = kind == "calendar"
        return self

    def as_of(self, day: date | str) -> "PanelQuery":
        """Day that ages and recent-event windows are measured from; default today."""
        self._as_of = day
        return self

    def trailing(self) -> "PanelQuery":
        """Recent-event signals count back from each row's own date."""
        self._trailing = True
        return self

    def version_as_of(self, when: datetime | str) -> "PanelQuery":
        """Read the versions that were newest at ``when``."""
        self._version_as_of = when
        return self

    def using(self, **inputs: DataFrame) -> "PanelQuery":
        """Inputs of panel features, e.g. ``sp500_constituents=df`` (see operators.panel_features)."""
        self._inputs.update(inputs)
        return self

    def benchmark(self, symbol: str) -> "PanelQuery":
        self._benchmark = symbol
        return self

    def with_inputs(self) -> "PanelQuery":
        """Also return the stored fields that the features were computed from."""
        self._keep_inputs = True
        return self

    # -- planning ----------------------------------------------------------
    def _classify(self):
        panel, derived, base = [], [], []
        for name in self._fields:
            if name in self.registry.panel_features:
                panel.append(name)
            elif name in self.registry.features:
                derived.append(name)
            elif name in self.catalog:
                base.append(name)
            else:
                raise ValueError(f"unknown field {name!r}")
        return base, derived, panel

    def _validate(self) -> None:
        if self._symbols is None or (isinstance(self._symbols, list) and not self._symbols):
            raise ValueError("no symbols given; call symbols() or all_symbols()")
        if not self._fields:
            raise ValueError("no fields given; call select()")

    def _group(self, names: Sequence[str]) -> dict[str, list[str]]:
        """Columns to read per table; tables stored in one frame are read as one."""
        grouped: dict[str, list[str]] = {}
        for name in names:
            table, field = self.catalog.resolve(name)
            for seen in grouped:
                if self.source.same_rows(seen, table):
                    table = seen
                    break
            columns = grouped.setdefault(table, [])
            if field.name not in columns:
                columns.append(field.name)
        return grouped

    def _target(self, tables: Sequence[str]) -> Grain:
        if self._grain is not None:
            return self._grain
        if self._spine is not None:
            return self.catalog[self._spine].grain
        timed = [self.catalog[t].grain for t in tables if self.catalog[t].grain.timed]
        return min(timed) if timed else Grain.SNAPSHOT

    def _choose_spine(self, tables: Sequence[str], target: Grain) -> str:
        if self._spine is not None:
            return self._spine
        specs = [self.catalog[t] for t in tables]
        timed = [s for s in specs if s.grain.timed]
        fine = [s for s in timed if s.grain <= target]
        for choice in (
            [s for s in fine if s.by_symbol],
            [s for s in timed if s.by_symbol],
            fine,
            timed,
            specs,
        ):
            if choice:
                return choice[0].name
        return "daily_price"

    def execute(self) -> DataFrame:
        """The result as a lazy DataFrame, unordered; see :meth:`ordered`."""
        self._validate()
        base, derived, panel = self._classify()
        features = self.registry.features
        native = self._native_groups(derived) if self._native else {}
        row_level = [d for d in derived if not any(d in names for names in native.values())]

        built = FeatureSet([(n, features[n].build) for n in row_level], self._as_of_day())
        needed = base + built.fields
        for name in panel:
            needed += self.registry.panel_features[name].deps
        grouped = self._group(needed)
        if self._spine and self._spine not in grouped:
            grouped = {self._spine: [], **grouped}
        if not grouped and native:
            grouped = {self._choose_spine([t for ts in native for t in ts], Grain.DAILY): []}
        if not grouped:
            grouped = {"daily_price": []}
        target = self._target([*grouped, *[t for ts in native for t in ts]])
        if target is Grain.SNAPSHOT and any(self.catalog[t].grain.timed for t in grouped):
            raise ValueError("the snapshot grain holds no dated tables")

        df, keys = self._aligned(grouped, target, native)
        stored = [c for cols in grouped.values() for c in cols]
        # A feature may bear the name of the stored field it was computed from.
        slots = {n: f"__feature_{n}" for n in row_level if n in stored}
        if row_level:
            partition = [k for k in keys if k == "symbol"]
            order = "date" if "date" in keys else "symbol"
            calendar = None
            if self._calendar_lags:
                if target < Grain.MONTHLY or not target.timed:
                    raise ValueError("calendar lags need a monthly, quarterly or annual grain")
                calendar = target
            df = built.evaluate(df, partition, order, slots, calendar)
        df = self._with_panel_features(df, panel, target)
        if self._warm_up and self._start is not None and "date" in keys:
            first = target.period_start(F.lit(self._start).cast("date"))
            df = df.filter(F.col("date") >= first)

        out: dict[str, Column] = {k: F.col(k) for k in keys}
        for name in self._fields:
            computed = name in self.registry
            stored_name = name if computed else self.catalog.resolve(name)[1].name
            out[name] = F.col(slots.get(name, stored_name)).alias(name)
        if self._keep_inputs:
            for c in stored:
                out.setdefault(c, F.col(c))
        return df.select(*out.values())

    def ordered(self) -> DataFrame:
        """The result ordered by symbol and date (O01): a range-partitioned sort."""
        df = self.execute()
        return df.orderBy(*[k for k in ("symbol", "date") if k in df.columns])

    # -- pieces ------------------------------------------------------------
    def _symbol_filter(self):
        return None if self._symbols is _EVERYTHING else self._symbols

    def _by_period(self, spec: TableSpec) -> bool:
        return "period" in spec.keys and "period" in self.source.frame(spec.name).columns

    def _annual(self) -> tuple[Column, Column | None]:
        """Whether a row is a full year's, and the filter on it."""
        annual = F.coalesce(F.col("period") == "FY", F.lit(False))
        return annual, {None: None, "annual": annual, "quarter": ~annual}[self._period]

    def _scan(self, spec: TableSpec, columns: Sequence[str], start: date | str | None) -> DataFrame:
        args = (spec.name, columns, self._symbol_filter(), start, self._end, self._version_as_of)
        if not self._by_period(spec):
            return self.source.scan(*args).select(*[k for k in spec.keys if k != "period"], *columns)
        # Statements are keyed by period too; make them unique per (symbol, date).
        # Where a full-year and a quarterly row share a date, the quarterly one wins.
        annual, where = self._annual()
        df = self.source.scan(
            *args, where=where, collapse=("symbol", "date"), prefer=(annual, F.col("period"))
        )
        return df.drop("period")

    def _carried(self, spec: TableSpec, columns: Sequence[str], target: Grain) -> DataFrame:
        """Rows to carry forward: those in range, and per symbol the last one before it."""
        start = self._first_day()
        if start is None:
            return self._scan(spec, columns, None)
        first = target.first_day(start)  # a rolled-up row bears the first day of its period
        where, prefer = None, ()
        if self._by_period(spec):
            annual, where = self._annual()
            prefer = (~annual, descending(F.col("period")))
        seeds = self.source.seeds(spec.name, columns, first, self._symbol_filter(), self._version_as_of, where, prefer)
        return seeds.unionByName(self._scan(spec, columns, first).select(*seeds.columns))

    def _roll(self, df: DataFrame, spec: TableSpec, columns: Sequence[str], target: Grain) -> DataFrame:
        how = {c: self._rollups.get(c, self.catalog.resolve(c)[1].rollup) for c in columns}
        keys = [k for k in spec.keys if k == "symbol"]
        return roll_up(df, target, how, keys)

    def _aligned(self, grouped, target: Grain, native) -> tuple[DataFrame, list[str]]:
        spine_name = self._choose_spine(list(grouped), target)
        spec = self.catalog[spine_name]
        columns = grouped[spine_name]
        df = self._scan(spec, columns, self._first_day())
        if not spec.grain.timed:
            for name, cols in grouped.items():
                if name != spine_name:
                    df = join_snapshot(df, self._scan(self.catalog[name], cols, self._first_day()))
            return df, ["symbol"]

        for name in grouped:
            if self.catalog[name].by_symbol and not spec.by_symbol:
                raise ValueError(f"{name} needs a symbol, which the spine {spine_name} lacks")
        rolled = spec.grain < target
        if rolled:
            df = self._roll(df, spec, columns, target)
        keys = [k for k in ("symbol", "date") if k in spec.keys]

        snapshots, carried = [], []
        for name, cols in grouped.items():
            if name == spine_name:
                continue
            other = self.catalog[name]
            if not other.grain.timed:
                snapshots.append((other, cols))
                continue
            later = other.grain > target and other.by_symbol and spec.by_symbol
            if later:
                carried.append((self._carried(other, cols, target), cols))
                continue
            right = self._scan(other, cols, self._first_day())
            on = [k for k in ("symbol",) if k in other.keys and k in spec.keys]
            other_rolled = other.grain < target
            if other_rolled:
                right = self._roll(right, other, cols, target)
            elif rolled:
                # A native coarse table beside a rolled-up spine: its last row of the period.
                right = roll_up(right, target, {c: "last" for c in cols}, on)
            if not other.by_symbol and set(other.keys) != {"date"}:
                raise ValueError(f"{name} is keyed by {', '.join(other.keys)}; only tables keyed by date alone join by date")
            if not other.by_symbol and (other_rolled or rolled or self.source.versioned(name)):
                # Reduced to one row per date above: at most 366 rows a year.
                right = F.broadcast(right)
            if rolled == other_rolled and not (rolled or other_rolled):
                df = join_exact(df, right, [*on, "date"])
            else:
                df = join_period(df, right, target, on)

        for tables, names in native.items():
            carried.append((self._native_frame(tables, names), names))
        if carried:
            df = carry_forward(df, carried, how=self._carry)
        for other, cols in snapshots:
            df = join_snapshot(df, self._scan(other, cols, self._first_day()))
        return df, keys

    def _native_groups(self, derived: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
        """Features whose tables all share one grain coarser than the result's."""
        base, _, panel = self._classify()
        tables = {t for n in base for t in [self.catalog.resolve(n)[0]]}
        deps = {d: tuple(self._group(self.registry.features[d].deps)) for d in derived}
        everything = [*tables, *[t for ts in deps.values() for t in ts]]
        for name in panel:
            everything += self._group(self.registry.panel_features[name].deps)
        target = self._target(everything)
        groups: dict[tuple[str, ...], list[str]] = {}
        for name, owners in deps.items():
            grains = {self.catalog[t].grain for t in owners}
            if len(grains) == 1 and (g := grains.pop()).timed and g > target:
                if all(self.catalog[t].by_symbol for t in owners):
                    groups.setdefault(owners, []).append(name)
        return groups

    def _native_frame(self, tables: tuple[str, ...], names: Sequence[str]) -> DataFrame:
        sub = PanelQuery(self.source, self.registry)
        sub.__dict__.update(
            _symbols=self._symbols, _end=self._end, _period=self._period, _as_of=self._as_of,
            _version_as_of=self._version_as_of, _calendar_lags=self._calendar_lags,
        )
        return sub.select(*names).execute()

    def _as_of_day(self) -> Column:
        day = self._as_of if self._as_of is not None else self._end
        return F.current_date() if day is None else F.lit(day).cast("date")

    def _event_days(self, reach: int) -> tuple[date | None, date | str | None]:
        """First and last day of the events that recent-event signals look at."""
        if self._trailing:
            start = self._first_day()
            return None if start is None else _as_date(start) - timedelta(reach), self._end
        last = self._as_of if self._as_of is not None else self._end
        return None if last is None else _as_date(last) - timedelta(reach), last

    def _with_panel_features(self, df: DataFrame, panel: Sequence[str], target: Grain) -> DataFrame:
        families: dict[str, list[str]] = {}
        for name in panel:
            families.setdefault(self.registry.panel_features[name].family, []).append(name)
        for family, names in families.items():
            needs = self.registry.panel_features[names[0]].needs
            inputs: dict = {n: self._input(n, target) for n in needs}
            inputs.update(as_of=self._as_of_day(), trailing=self._trailing)
            df = self.registry.families[family](df, names, inputs)
        return df

    def _input(self, name: str, target: Grain) -> DataFrame:
        if name in self._inputs:
            return self._inputs[name]
        if name == "benchmark":
            prices = self.source.scan("daily_price", ["close"], [self._benchmark])
            prices = in_range(prices, self._first_day(), self._end)
            spec = self.catalog["daily_price"]
            if spec.grain < target and target.timed:
                prices = self._roll(prices, spec, ["close"], target)
            return prices.select("date", "close")
        if name in EVENTS and self.source.holds(EVENTS[name][0]):
            # A key (symbol, date) holds several events: all rows of its newest load count.
            table, columns, signals = EVENTS[name]
            first, last = self._event_days(S.reach(signals()))
            rows = self.source.scan(
                table, columns or None, self._symbol_filter(), first, last, self._version_as_of,
                whole_loads=True,
            )
            return rows.withColumnsRenamed(columns)
        raise ValueError(f"panel feature input {name!r} not given; pass it with using({name}=...)")


def _as_date(day: date | str) -> date:
    return date.fromisoformat(str(day)[:10])


def discover(spark, registry: FeatureRegistry, category: str | None = None) -> DataFrame:
    """Registered features with category and dependencies (Q09)."""
    rows = []
    for f in registry.features.values():
        view = f.view()
        rows.append((f.name, f.category, "window" if view.windowed else "row", sorted(view.fields)))
    for f in registry.panel_features.values():
        rows.append((f.name, f.category, "panel", sorted(f.deps)))
    rows = [r for r in rows if category in (None, r[1])]
    return spark.createDataFrame(
        rows, "feature string, category string, kind string, reads array<string>"
    )
