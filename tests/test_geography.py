"""Moves between countries: probabilities against counts made row by row."""

import random
from collections import Counter
from datetime import datetime, time, timedelta

from frames import AS_OF, customers, transactions

from ledgerline import rules
from ledgerline.plans import geography


def _row(who, days_ago, country, hour=0, amount=10):
    day = AS_OF - timedelta(days=days_ago)
    return dict(customer_id=who, transaction_date=day, merchant_country=country, amount_gbp=amount,
                transaction_timestamp=datetime.combine(day, time(hour)))


def _gap(days):
    return "same day" if days == 0 else "1-3 days" if days <= 3 else "4-14 days" if days <= 14 else "15+ days"


def by_hand(rows, segments):
    """(scored recent moves, all moves) from plain counting."""
    cells = {}
    for r in rows:
        if r["merchant_country"] is None or (AS_OF - r["transaction_date"]).days > 365:
            continue
        first, n = cells.get((r["customer_id"], r["transaction_date"], r["merchant_country"]), (r["transaction_timestamp"], 0))
        cells[r["customer_id"], r["transaction_date"], r["merchant_country"]] = min(first, r["transaction_timestamp"]), n + 1
    moves, state, paid, total, asked, last, everything = Counter(), Counter(), Counter(), Counter(), [], {}, Counter()
    for (who, day, country), (_, n) in sorted(cells.items(), key=lambda c: (c[0][0], c[0][1], c[1][0], c[0][2])):
        seg, recent = segments[who], (AS_OF - day).days <= 30
        steps = [(seg, "same day", country, country)] * (n - 1)
        if who in last:
            before, since = last[who]
            steps.append((seg, _gap((day - since).days), before, country))
            if recent:
                asked.append((who, day, steps[-1]))
        everything.update(steps)
        if not recent:
            moves.update(steps)
            state.update(s[:3] for s in steps)
            paid[seg, country] += n
            total[seg] += n
        last[who] = country, day
    out = {}
    for who, day, move in asked:
        share = (paid[move[0], move[3]] * 249 + 1) / ((total[move[0]] + 1) * 249)
        out[who, day, move[3]] = (moves[move] + 10 * share) / (state[move[:3]] + 10)
    return out, everything


def test_equals_counting(spark):
    r = random.Random(3)
    segments = {f"C{i}": ["Retail", "Premier", "Unknown"][i % 3] for i in range(40)}
    rows = [_row(f"C{r.randint(0, 39)}", r.choice([r.randint(0, 400), r.randint(0, 60)]),
                 r.choice(["GB", "GB", "GB", "GB", "FR", "US", "DE", None]), r.randint(0, 23)) for _ in range(3000)]
    rows += [_row("C1", 2, "KP"), _row("C2", 3, "KP", 1), _row("C2", 3, "GB", 2)]  # countries never seen before
    who = customers(spark, [dict(customer_id=c, customer_segment=None if s == "Unknown" else s) for c, s in segments.items()])
    txn = transactions(spark, rows)
    wanted, everything = by_hand(rows, segments)
    got = {(x.customer_id, x.transaction_date, x.merchant_country): x.probability
           for x in geography.geographic_scores(txn, who, AS_OF).collect()}
    assert got.keys() == wanted.keys() and all(abs(got[k] - wanted[k]) < 1e-12 for k in wanted)
    counted = geography.transition_counts(geography.country_moves(txn, who, AS_OF)).collect()
    assert {(x.customer_segment, x.gap, x.previous_country, x.merchant_country): x.moves for x in counted} == everything
    alerts = geography.aml_geographic_anomaly(txn, who, AS_OF).collect()
    assert {(x.customer_id, x.transaction_date, x.merchant_country) for x in alerts} == {k for k, p in wanted.items() if p < 0.1}
    assert ("C1", AS_OF - timedelta(days=2), "KP") in {(x.customer_id, x.transaction_date, x.merchant_country) for x in alerts}


def test_usual_travel_is_left_alone_and_the_odd_trip_found(spark):
    """A segment that often goes to France: going there is no alert, nor is coming back; a first trip to Japan is."""
    rows = [_row(f"C{i}", 40 + 2 * d, ["GB", "FR"][d % 2]) for i in range(20) for d in range(20)]
    rows += [_row("C0", 5, "FR"), _row("C0", 4, "GB"), _row("C1", 5, "JP", amount=700), _row("C1", 5, "JP", 3, amount=5)]
    who = customers(spark, [dict(customer_id=f"C{i}") for i in range(20)])
    [alert] = geography.aml_geographic_anomaly(transactions(spark, rows), who, AS_OF).collect()
    assert (alert.customer_id, alert.merchant_country, alert.payments, alert.amount_gbp) == ("C1", "JP", 2, 705)
    assert alert.probability < 0.01


def test_order_within_a_day_is_that_of_the_first_payments(spark):
    rows = [_row("C1", 9, "US", 8), _row("C1", 9, "DE", 6), _row("C1", 9, "US", 5)]
    got = geography.country_moves(transactions(spark, rows), customers(spark, [{}]), AS_OF).collect()
    assert {(r.previous_country, r.merchant_country, r.gap) for r in got} == {(None, "US", None), ("US", "DE", "same day")}


def test_nothing_to_score(spark):
    who = customers(spark, [{}])
    for rows in ([], [_row("C1", 1, "FR")], [_row("C1", 1, None)], [_row("C9", 1, "FR"), _row("C9", 2, "GB")]):
        assert geography.geographic_scores(transactions(spark, rows), who, AS_OF).collect() == []
    assert rules.GEO_GAPS[0] == (0, "same day")
