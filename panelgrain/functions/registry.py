"""Feature registration and discovery."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .context import Builder, PanelView, dependencies


@dataclass(frozen=True)
class Feature:
    """A column computed row-wise or over per-symbol windows."""

    name: str
    build: Builder
    category: str

    def view(self) -> PanelView:
        view = PanelView()
        self.build(view)
        return view

    @property
    def deps(self) -> list[str]:
        return dependencies(self.build)


@dataclass(frozen=True)
class PanelFeature:
    """A column that needs the whole panel: recursion, a reference series, event tables.

    Features of one ``family`` are computed together by one call
    ``apply(df, names, inputs)``; ``needs`` names the inputs the family reads.
    """

    name: str
    family: str
    category: str
    deps: tuple[str, ...]
    needs: tuple[str, ...] = ()


Family = Callable[[DataFrame, Sequence[str], dict], DataFrame]


class FeatureRegistry:
    def __init__(self):
        self.features: dict[str, Feature] = {}
        self.panel_features: dict[str, PanelFeature] = {}
        self.families: dict[str, Family] = {}

    def add(self, category: str, name: str, build: Builder) -> None:
        if name in self:
            raise ValueError(f"feature {name!r} is already registered")
        self.features[name] = Feature(name, build, category)

    def add_all(self, category: str, builders: dict[str, Builder]) -> None:
        for name, build in builders.items():
            self.add(category, name, build)

    def feature(self, name: str, category: str = "custom"):
        """Decorator: ``@registry.feature("name")`` on a function of a PanelView."""
        def register(build: Builder) -> Builder:
            self.add(category, name, build)
            return build
        return register

    def panel(
        self, family: str, category: str, deps: Sequence[str], names: Sequence[str],
        needs: Sequence[str] = (),
    ):
        """Decorator for a family function ``(df, names, inputs) -> df``."""
        def register(apply: Family) -> Family:
            self.families[family] = apply
            for name in names:
                if name in self:
                    raise ValueError(f"feature {name!r} is already registered")
                self.panel_features[name] = PanelFeature(
                    name, family, category, tuple(deps), tuple(needs)
                )
            return apply
        return register

    def __contains__(self, name: str) -> bool:
        return name in self.features or name in self.panel_features

    def names(self, category: str | None = None) -> list[str]:
        every = [*self.features.values(), *self.panel_features.values()]
        return sorted(f.name for f in every if category in (None, f.category))

    def categories(self) -> list[str]:
        every = [*self.features.values(), *self.panel_features.values()]
        return sorted({f.category for f in every})
