"""Every report comes in its order, ties included. Row comparisons with SQL can't see this."""

import pytest

from ledgerline.checks import registry
from ledgerline.checks.registry import star_queries
from ledgerline.plans import churn_model
from ledgerline.sources import order_star

# report: its order, a minus for descending
ORDERS = {
    "rfm_segments": ["-rfm_composite_score", "customer_id"],
    "cross_sell": ["-opportunity_count", "-total_balance_gbp", "customer_id"],
    "aml_structuring_alerts": ["alert_severity", "-rolling_7d_total_gbp", "customer_id", "transaction_date"],
    "aml_velocity_alerts": ["-spend_multiplier", "customer_id", "transaction_date"],
    "aml_round_amount_alerts": ["-total_exposure_gbp", "customer_id", "amount_gbp"],
    "aml_high_risk_exposure": ["-foreign_gbp", "customer_id"],
    "v_monthly_pnl": ["-snapshot_month", "-total_revenue_gbp", "product_type", "product_family", "region", "customer_segment"],
}
SCORES = ["-churn_probability", "customer_id"]


class Down:
    """Sorts the other way round."""

    def __init__(self, value):
        self.value = value

    def __lt__(self, other):
        return other.value < self.value

    def __eq__(self, other):
        return self.value == other.value


def in_order(rows, order):
    def key(r):
        return [Down(r[c[1:]]) if c[0] == "-" else r[c] for c in order]

    return rows == sorted(rows, key=key)


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_order(spark, sf_dir, name):
    rows = star_queries()[name](order_star.load(spark, sf_dir)).collect()
    assert len(rows) > 5 and in_order(rows, ORDERS[name])
    lead = [c.lstrip("-") for c in ORDERS[name]][:-1]
    assert name == "v_monthly_pnl" or len({tuple(r[c] for c in lead[:1]) for r in rows}) < len(rows)  # there are ties to pin


def test_order_of_scores(spark, sf_small):
    assert in_order(registry.queries()["churn_scores_declared"](spark, sf_small).collect(), SCORES)


def test_order_of_fitted_scores(spark, sf_small):
    """The query of that name compares scores with the formula and has no order of its own; the report has."""
    for _, _, features, model in registry._fits(spark, sf_small):
        rows = churn_model.score_churn(model, features).collect()
        assert len(rows) > 5 and in_order(rows, SCORES)
