"""F001–F339: one query per feature category, every feature of it as a column."""

from __future__ import annotations

from .. import oracle as O
from .. import views as V

# Category → the ids it covers.
CATEGORIES = {
    "profitability": "f001_f020",
    "liquidity": "f021_f033",
    "leverage": "f034_f050",
    "efficiency": "f051_f070",
    "valuation": "f071_f092",
    "cash_flow": "f093_f106",
    "growth": "f107_f136",
    "dupont": "f137_f143",
    "earnings_quality": "f144_f160",
    "per_share": "f161_f171",
    "dividend": "f172_f182",
    "risk": "f183_f202",
    "technical": "f203_f232",
    "momentum": "f233_f246",
    "composite": "f247_f266",
    "analyst": "f267_f278",
    "macro": "f279_f287",
    "event_driven": "f288_f302",
    "esg": "f303_f306",
    "institutional": "f307_f313",
    "historical": "f314_f332",
    "insider": "f333_f339",
}


def _category(name):
    def run(spark, sf_dir):
        wanted = [f.name for f in V.registry().features.values() if f.category == name]
        return V.rounded(V.query(spark, sf_dir).select(wanted).as_of(V.AS_OF).execute())
    return run


QUERIES = {
    f"{ids}_{name}": (_category(name), O.file(f"features_{name}"))
    for name, ids in CATEGORIES.items()
}
