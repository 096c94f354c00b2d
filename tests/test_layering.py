"""Credits matched with later debits, oldest money first, against a queue worked row by row."""

import random
from collections import defaultdict, deque
from datetime import timedelta
from decimal import Decimal

from frames import AS_OF, customers, transactions

from ledgerline.plans import aml


def _day(n):
    return AS_OF - timedelta(days=n)


def _row(kind, amount, day, who="C1"):
    return dict(transaction_type=kind, amount_gbp=amount, transaction_date=_day(day), customer_id=who)


def by_queue(rows, days):
    flows = defaultdict(lambda: {"Credit": Decimal(0), "Debit": Decimal(0)})
    for r in rows:
        flows[r["customer_id"], r["transaction_date"]][r["transaction_type"]] += Decimal(str(r["amount_gbp"]))
    queues, out = defaultdict(deque), {}
    for (who, day), f in sorted(flows.items()):
        if f["Credit"]:
            out[who, day] = [f["Credit"], Decimal(0)]
            queues[who].append([day, f["Credit"]])
        left = f["Debit"]
        while left and queues[who]:
            first = queues[who][0]
            size = min(left, first[1])
            left, first[1] = left - size, first[1] - size
            if (day - first[0]).days <= days:
                out[who, first[0]][1] += size
            if not first[1]:
                queues[who].popleft()
    return {k: tuple(v) for k, v in out.items()}


def _got(df):
    return {(r.customer_id, r.transaction_date): (r.credits_gbp, r.passed_on_gbp) for r in df.collect()}


def test_equals_a_queue(spark):
    r = random.Random(5)
    rows = [_row(r.choice(["Credit", "Debit"]), r.choice([r.randint(1, 40), 500, "0.01"]), r.randint(0, 60), f"C{r.randint(0, 30)}")
            for _ in range(3000)]
    for days in (0, 3, 90):
        assert _got(aml.layering_daily(transactions(spark, rows), days)) == by_queue(rows, days)


def test_debits_before_or_beyond_the_credits_use_nothing(spark):
    rows = [_row("Debit", 900, 9), _row("Credit", 100, 8), _row("Debit", 500, 7), _row("Credit", 50, 6), _row("Debit", 20, 1)]
    assert _got(aml.layering_daily(transactions(spark, rows), 3)) == {("C1", _day(8)): (100, 100), ("C1", _day(6)): (50, 0)}


def test_alert_needs_both_limits(spark):
    rows = [_row("Credit", 5000, 5, "A"), _row("Debit", 4000, 2, "A"), _row("Credit", 5000, 5, "B"), _row("Debit", "3999.99", 2, "B"),
            _row("Credit", "4999.99", 5, "C"), _row("Debit", 4999, 2, "C"), _row("Credit", 5000, 5, "D"), _row("Debit", 5000, 1, "D")]
    who = customers(spark, [dict(customer_id=c) for c in "ABCD"])
    [row] = aml.aml_layering(transactions(spark, rows), who).collect()
    assert (row.customer_id, row.transaction_date, row.passed_on_pct) == ("A", _day(5), 80)


def test_no_pairs_and_nothing_to_match(spark):
    txn = transactions(spark, [_row("Debit", 5, 1), _row("Fee", 5, 1), _row("Credit", -5, 1)])
    assert aml.layering_daily(txn).collect() == []
    plan = aml.layering_daily(txn)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
