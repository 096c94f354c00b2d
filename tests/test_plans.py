"""What must not appear in any physical plan."""

import re

import pytest

from ledgerline.checks import registry
from ledgerline.sources import order_star

QUERIES = registry.star_queries()


@pytest.fixture(scope="module")
def star(spark, sf_small):
    return order_star.load(spark, sf_small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_is_distributed(star, name):
    plan = QUERIES[name](star)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad
    # a single partition is only for aggregates without keys, never under a window or sort
    for line in re.findall(r".*SinglePartition.*", plan):
        assert "ENSURE_REQUIREMENTS" in line
        assert name in {"dim_date", "monthly_executive_summary", "executive_summary_from_base", "staging_validate"}, line


def test_scans_read_needed_columns_only(star):
    plan = QUERIES["aml_round_amount_alerts"](star)._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"ReadSchema: struct<([^>]*)", plan)
    lineitem = next(r for r in read if "l_orderkey" in r)
    assert "l_tax" not in lineitem and "l_discount" not in lineitem


def test_catalogue_join_does_not_shuffle_accounts(star):
    plan = QUERIES["product_holdings"](star)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [product_id" in plan and "hashpartitioning(product_id" not in plan


@pytest.mark.parametrize("name", ["approx_distinct_accounts", "approx_distinct_merchants"])
def test_estimates_keep_one_sketch_per_channel(star, name):
    plan = QUERIES[name](star)._jdf.queryExecution().executedPlan().toString()
    sketches = [line for line in plan.splitlines() if "approx_count_distinct" in line and "keys=[" in line]
    assert sketches and all(re.search(r"keys=\[channel#\d+\]", line) for line in sketches)


def test_snapshots_are_spread_before_they_multiply(star):
    """Twelve wide rows come of each narrow one; the step before must not be merged by the narrow rows' bytes."""
    plan = star.accounts._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan[plan.index("Generate explode"):]


def test_account_counts_group_where_they_join(star):
    """One shuffle of the account rows, not merged by their compressed bytes; the next one sees groups only."""
    plan = QUERIES["pnl_account_counts"](star)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(customer_id#\d+, share#\d+, \d+\), REPARTITION_BY_NUM", plan)
    assert not re.search(r"hashpartitioning\([^)]*account_id", plan)


def test_summaries_do_not_sort_their_inputs(star):
    plan = QUERIES["aml_flag_summary"](star)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1


def test_one_month_summary_reads_one_month(spark, star, tmp_path):
    from ledgerline import schemas
    from ledgerline.plans import pnl
    from ledgerline.sources import storage

    acct = storage.write_table(star.accounts, schemas.ACCOUNTS, str(tmp_path / "a"))
    txn = storage.write_table(star.transactions.limit(20), schemas.TRANSACTIONS, str(tmp_path / "t"))
    view = pnl.monthly_pnl(acct, star.products, star.customers, txn, report_month=order_star.AS_OF)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")  # print filters in full
    plan = pnl.executive_summary(view, order_star.AS_OF)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    found = re.findall(r"PartitionFilters: \[([^\]]+)\]", plan)
    assert len(found) == 2 and all("2024-12-01" in filters for filters in found)
