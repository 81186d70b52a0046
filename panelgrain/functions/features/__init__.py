"""The built-in features."""

from __future__ import annotations

from ..registry import FeatureRegistry
from . import market, reference_data, statements, valuation


def default_registry() -> FeatureRegistry:
    from ...operators import panel_features

    registry = FeatureRegistry()
    for module in (statements, valuation, market, reference_data, panel_features):
        module.register(registry)
    return registry
