"""Every registered query against its SQL, cell by cell."""

import functools
from datetime import date

import pytest

import __spark_entry__ as entry
from ledgerline import rules
from ledgerline.checks import compare, oracle, registry
from ledgerline.sources import dimensions

QUERIES, EXPECTED = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_matches(spark, sf_dir, duck, name):
    assert compare.difference(QUERIES[name](spark, sf_dir), duck, EXPECTED[name]) is None


def test_every_expected_answer_has_a_query():
    assert set(EXPECTED) == set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 150
    assert "rfm_segment" in df.columns


def _swapped(values, i, j):
    out = list(values)
    out[i], out[j] = out[j], out[i]
    return out


@pytest.mark.parametrize(("constant", "value", "query"), [
    ("UK_BANK_HOLIDAYS", [date(2022, 1, 4), *rules.UK_BANK_HOLIDAYS[1:]], "dim_date"),
    ("PRODUCT_CATALOGUE", [(*rules.PRODUCT_CATALOGUE[0][:5], "0.01", *rules.PRODUCT_CATALOGUE[0][6:]), *rules.PRODUCT_CATALOGUE[1:]], "dim_products"),
    ("GEN_REGIONS", _swapped(rules.GEN_REGIONS, 0, 1), "dim_customers"),
    ("RFM_SEGMENTS", _swapped(rules.RFM_SEGMENTS, 0, 1), "rfm_segments"),
    ("STRUCTURING_ALERT", "Structuring", "aml_structuring_alerts"),
    ("ROUND_DAYS", 15, "aml_round_amount_alerts"),
    ("CHURN_TIERS", [(0.8, "Imminent (75%+)"), *rules.CHURN_TIERS[1:]], "churn_scores_declared"),
])
def test_a_mistyped_constant_shows(spark, sf_dir, duck, monkeypatch, constant, value, query):
    monkeypatch.setattr(rules, constant, value)
    if constant == "UK_BANK_HOLIDAYS":  # a default, bound when the function was defined
        monkeypatch.setattr(dimensions, "dim_date", functools.partial(dimensions.dim_date, holidays=value))
    assert compare.difference(registry.queries()[query](spark, sf_dir), duck, EXPECTED[query]) is not None
