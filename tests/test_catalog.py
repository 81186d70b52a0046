import pytest

from panelgrain import Grain, default_catalog
from panelgrain.functions.features import default_registry
from panelgrain.sources.catalog import camel


def test_all_tables_and_fields():
    c = default_catalog()
    assert len(c.tables) == 44
    assert len(c.owner) + len(c.aliases) == 471
    assert sum(len(t.fields) for t in c.tables.values()) == 465


def test_first_table_owns_a_shared_name():
    c = default_catalog()
    assert c.resolve("reported_currency")[0] == "income_statement"
    assert c.resolve("enterprise_value")[0] == "key_metrics"
    assert c.resolve("company_name")[0] == "profile"
    assert c.resolve("split_numerator")[0] == "splits_data"


def test_source_names_follow_the_rule_or_the_exception():
    c = default_catalog()
    assert camel("total_stockholders_equity") == "totalStockholdersEquity"
    assert c["income_statement"].fields["sga_expenses"].source == (
        "sellingGeneralAndAdministrativeExpenses")
    assert c["ratios_ttm"].fields["ttm_quick_ratio"].source == "quickRatioTTM"
    assert c["quote"].fields["quote_market_cap"].source == "marketCap"
    assert c["dcf_data"].fields["dcf_stock_price"].source == "Stock Price"


def test_roll_up_defaults():
    fields = default_catalog()["daily_price"].fields
    assert {n: f.rollup for n, f in fields.items()} == {
        "open": "first", "high": "max", "low": "min", "close": "last", "adj_close": "last",
        "volume": "sum", "vwap": "mean", "change": "sum", "change_pct": "sum"}


def test_schema_and_grain():
    c = default_catalog()
    schema = c["income_statement"].schema(versioned=True)
    assert schema.fieldNames()[:3] == ["symbol", "date", "period"]
    assert not schema["symbol"].nullable and schema["revenue"].dataType.typeName() == "long"
    assert "_fetched_at" in schema.fieldNames()
    assert Grain.parse("Quarterly") is Grain.QUARTERLY and Grain.DAILY < Grain.WEEKLY
    with pytest.raises(ValueError):
        Grain.parse("hourly-ish")
    with pytest.raises(ValueError):
        c.resolve("no_such_field")


def test_registry_counts():
    r = default_registry()
    assert len(r.features) == 339
    assert len(r.panel_features) == 30
    assert len(r.names("technical")) == 30 + 8
    assert "composite" in r.categories() and "senate" in r.categories()
    with pytest.raises(ValueError):
        r.add("custom", "return_1d", lambda p: p["close"])
