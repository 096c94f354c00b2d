"""The expected answer of every registered query as DuckDB SQL over the raw test tables.

Written apart from the Spark code: no shared expressions, and every fixed value is stated
here again, so that a mistyped one on either side shows. The star schema is put in front of each query as common table expressions. Money comes out as
double and dates as ISO text, as in :func:`ledgerline.checks.registry.comparable`.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2024-12-31'"


def _money(pence: str) -> str:
    return f"cast(cast({pence} as decimal(18,0)) * cast(0.01 as decimal(3,2)) as decimal(18,2))"


def _pence(column: str) -> str:
    return f"cast(round({column} * 100) as bigint)"


def _rounded(num: str, den: str, digits: int) -> str:
    """num / den (whole numbers) rounded half away from zero, as a decimal."""
    n, d = f"({num})::hugeint", f"nullif(({den})::hugeint, 0)"
    whole = f"sign({n}) * sign({d}) * ((2 * abs({n}) * {10**digits} + abs({d})) // (2 * abs({d})))"
    unit = f"{10 ** -digits:.{digits}f}"
    return f"(cast({whole} as decimal(28,0)) * cast({unit} as decimal({digits + 1},{digits})))"


_ID = "lpad(k::varchar, greatest(8, length(k::varchar))::int, '0')"

STAR = {
    "dim_customers": f"""
        SELECT 'CUST' || {_ID} AS customer_id, region, customer_since, date_of_birth,
               CASE WHEN a BETWEEN 18 AND 24 THEN '18-24' WHEN a BETWEEN 25 AND 34 THEN '25-34'
                    WHEN a BETWEEN 35 AND 44 THEN '35-44' WHEN a BETWEEN 45 AND 54 THEN '45-54'
                    WHEN a BETWEEN 55 AND 64 THEN '55-64' ELSE '65+' END AS age_band,
               CASE WHEN (k * 11) % 100 < 60 THEN 'Retail' WHEN (k * 11) % 100 < 85 THEN 'Premier'
                    ELSE 'Private' END AS customer_segment,
               CASE WHEN (k * 29) % 20 = 0 THEN 'Pending' ELSE 'Verified' END AS kyc_status,
               CASE WHEN (k * 13) % 100 < 75 THEN 'Low' WHEN (k * 13) % 100 < 93 THEN 'Medium'
                    ELSE 'High' END AS risk_rating,
               (k * 23) % 201 - 100 AS nps_score,
               2024 - year(customer_since) AS tenure_years
        FROM (SELECT *, 2024 - year(date_of_birth) AS a
              FROM (SELECT c_custkey AS k, r_name AS region,
                           {AS_OF} - (6570 + (c_custkey * 7919) % 20000)::int AS date_of_birth,
                           {AS_OF} - (30 + (c_custkey * 104729) % 5400)::int AS customer_since
                    FROM customer JOIN nation ON c_nationkey = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey))""",
    # fixed values
    "dim_products": """
        SELECT product_id, product_code, product_name, product_type, product_family, interest_rate::decimal(38,9) AS interest_rate,
               fee_monthly::decimal(18,2) AS fee_monthly, credit_limit_max::decimal(18,2) AS credit_limit_max, true AS is_active,
               launch_date
        FROM (VALUES
          ('PRD001', 'CA_ADVANCE', 'Advance Current Account', 'Current Account', 'Deposits', 0, 0, NULL, DATE '2015-01-01'),
          ('PRD002', 'CA_SELECT', 'Select Current Account', 'Current Account', 'Deposits', 0, 12.95, NULL, DATE '2018-06-01'),
          ('PRD003', 'SA_FLEX', 'Flexible Saver', 'Savings', 'Deposits', 3.50, 0, NULL, DATE '2020-01-01'),
          ('PRD004', 'SA_FIXED12', 'Fixed Rate Bond 12M', 'Savings', 'Deposits', 5.10, 0, NULL, DATE '2023-01-01'),
          ('PRD005', 'SA_ISA', 'Cash ISA', 'Savings', 'Deposits', 3.80, 0, NULL, DATE '2016-04-06'),
          ('PRD006', 'CC_PLATINUM', 'Platinum Credit Card', 'Credit Card', 'Lending', 22.90, 0, 15000, DATE '2019-03-01'),
          ('PRD007', 'CC_CASHBACK', 'Cashback Credit Card', 'Credit Card', 'Lending', 19.90, 0, 10000, DATE '2021-01-01'),
          ('PRD008', 'LN_PERSONAL', 'Personal Loan', 'Loan', 'Lending', 8.90, 0, NULL, DATE '2017-01-01'),
          ('PRD009', 'LN_VEHICLE', 'Vehicle Finance Loan', 'Loan', 'Lending', 6.50, 0, NULL, DATE '2020-06-01'),
          ('PRD010', 'MG_RESIDENTIAL', 'Residential Mortgage', 'Mortgage', 'Lending', 4.25, 0, NULL, DATE '2010-01-01'),
          ('PRD011', 'MG_BTL', 'Buy-to-Let Mortgage', 'Mortgage', 'Lending', 5.10, 0, NULL, DATE '2012-01-01')
        ) v(product_id, product_code, product_name, product_type, product_family, interest_rate, fee_monthly,
            credit_limit_max, launch_date)""",
    "fact_transactions": f"""
        SELECT 'TXN' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || d
                   AS transaction_id,
               'CUST' || {_ID} AS customer_id,
               'ACC' || {_ID} || '-' || lpad((o_orderkey % 11 + 1)::varchar, 2, '0') AS account_id,
               'PRD' || lpad((o_orderkey % 11 + 1)::varchar, 3, '0') AS product_id,
               {AS_OF} - age::int AS transaction_date,
               CASE WHEN k % 50 = 49 THEN 'Transfer'
                    ELSE (['Debit', 'Debit', 'Debit', 'Credit', 'Transfer', 'ATM'])[1 + (l_partkey + l_linenumber) % 6]
                    END AS transaction_type,
               CASE WHEN k % 15 = 2 THEN 'International' WHEN k % 6 = 1 THEN 'Mortgage/Rent'
                    ELSE (['Groceries', 'Utilities', 'Transport', 'Entertainment', 'Mortgage/Rent', 'FX'])[1 + l_partkey % 6]
                    END AS transaction_category,
               'Merchant_' || (l_suppkey % 50) AS merchant_name,
               lpad((5000 + l_partkey % 12)::varchar, 4, '0') AS merchant_category_code,
               CASE WHEN l_suppkey % 10 = 0 THEN 'FR' ELSE 'GB' END AS merchant_country,
               {_money(f'''CASE WHEN planted AND (k // 25) % 7 = 6 THEN 99960 WHEN planted THEN 100000 * (1 + (k // 25) % 9)
                                WHEN k % 20 = 1 AND age > 7 THEN {_pence('l_extendedprice')} // 200
                                ELSE {_pence('l_extendedprice')} // 10 END''')} AS amount_gbp,
               (['Mobile', 'Online', 'Branch', 'ATM', 'POS'])[1 + l_partkey % 5] AS channel,
               l_suppkey % 10 = 0 AS is_international,
               l_suppkey % 20 = 7 AND l_linenumber = 7 AS is_flagged
        FROM (SELECT *, CASE WHEN planted THEN d % 31 ELSE d % 365 END AS age
              FROM (SELECT *, o_custkey AS k, o_custkey % 25 = 0 AND l_linenumber <= 4 AS planted,
                           date_diff('day', DATE '1995-01-01', l_shipdate::date) AS d
                    FROM lineitem JOIN orders ON l_orderkey = o_orderkey))""",
    "fact_accounts": f"""
        SELECT 'ACC' || {_ID} || '-' || lpad((pr + 1)::varchar, 2, '0') AS account_id,
               'CUST' || {_ID} AS customer_id,
               'PRD' || lpad((pr + 1)::varchar, 3, '0') AS product_id,
               (DATE '2024-01-01' + to_months(m::int))::date AS snapshot_month,
               status AS account_status,
               {_money(f"CASE WHEN status = 'Overdrawn' THEN -100 * (h % 500) ELSE {_pence('c_acctbal')} + (h % 97) * 15000 END")}
                   AS balance_gbp,
               CASE WHEN pr IN (5, 6) THEN {_money('100 * (h % 101)')} END AS utilisation_pct,
               CASE WHEN h % 13 = 0 THEN 30 + h % 60 ELSE 0 END AS days_in_arrears,
               CASE WHEN h % 17 = 0 THEN 1 + h % 3 ELSE 0 END AS missed_payments_3m,
               CASE WHEN pr >= 5 THEN {_money('(h % 97) * 325')} ELSE 0 END AS interest_charged_gbp,
               CASE WHEN pr BETWEEN 2 AND 4 THEN {_money('(h % 89) * 115')} ELSE 0 END AS interest_earned_gbp,
               CASE WHEN h % 4 = 0 THEN 12.95::decimal(18,2) ELSE 0 END AS fees_charged_gbp,
               CASE WHEN status = 'Closed' THEN {AS_OF} + (k % 120)::int END AS closed_date
        FROM (SELECT *, CASE WHEN m = 11 AND (k * 7 + pr * 3) % 20 = 0 THEN 'Closed'
                             WHEN h % 20 = 0 OR pr >= 2 AND odd THEN 'Dormant' WHEN h % 20 = 1 THEN 'Overdrawn'
                             ELSE 'Active' END AS status
              FROM (SELECT k, pr, odd, m, c_acctbal, k * 31 + pr * 17 + m AS h
                    FROM (SELECT o_custkey AS k, o_orderkey % 11 AS pr, bool_and(o_orderkey % 2 = 1) AS odd
                          FROM orders GROUP BY ALL)
                    JOIN customer ON c_custkey = k CROSS JOIN range(12) months(m)))""",
    "ref_merchant_categories": """
        SELECT DISTINCT lpad((5000 + p_partkey % 12)::varchar, 4, '0') AS mcc_code,
               'Merchant category ' || (5000 + p_partkey % 12) AS mcc_description,
               (['Groceries', 'Utilities', 'Transport', 'Entertainment', 'Mortgage/Rent', 'FX'])[1 + p_partkey % 12 % 6]
                   AS spending_category,
               p_partkey % 12 % 6 = 5 AS is_high_risk
        FROM part""",
}

# steps shared by several expected answers; each may use the tables above and earlier steps
STEPS = {
    "rfm_raw": f"""
        SELECT customer_id,
               date_diff('day', max(transaction_date), {AS_OF} - 1) AS recency_days,
               count(DISTINCT strftime(transaction_date, '%Y-%m')) AS frequency_months,
               sum(CASE WHEN transaction_type = 'Debit' THEN amount_gbp ELSE 0 END) AS monetary_gbp,
               count(*) AS total_transactions, count(DISTINCT merchant_name) AS unique_merchants,
               max(transaction_date) AS last_transaction_date, min(transaction_date) AS first_transaction_date
        FROM fact_transactions WHERE transaction_date >= DATE '2023-12-31' AND NOT is_flagged GROUP BY customer_id""",
    "rfm_scored": """
        SELECT *, 6 - ntile(5) OVER (ORDER BY recency_days, customer_id) AS r_score,
               ntile(5) OVER (ORDER BY frequency_months, customer_id) AS f_score,
               ntile(5) OVER (ORDER BY monetary_gbp, customer_id) AS m_score
        FROM rfm_raw""",
    "rfm_segments": f"""
        SELECT s.*,
               CASE WHEN r_score = 5 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
                    WHEN f_score >= 4 AND m_score >= 3 THEN 'Loyal Customers'
                    WHEN r_score >= 4 AND f_score BETWEEN 2 AND 3 THEN 'Potential Loyalists'
                    WHEN r_score = 5 AND f_score = 1 THEN 'New Customers'
                    WHEN r_score = 4 AND f_score = 1 THEN 'Promising'
                    WHEN r_score = 3 AND f_score >= 3 AND m_score >= 3 THEN 'Need Attention'
                    WHEN r_score BETWEEN 2 AND 3 AND f_score <= 2 THEN 'About To Sleep'
                    WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'At Risk'
                    WHEN r_score = 1 AND f_score >= 4 AND m_score >= 4 THEN 'Cannot Lose Them'
                    WHEN r_score <= 2 AND f_score <= 2 THEN 'Hibernating' ELSE 'Others' END AS rfm_segment,
               round((r_score + f_score + m_score) / 3.0, 2) AS rfm_composite_score,
               customer_segment, region, age_band, risk_rating, customer_since, tenure_years,
               CASE WHEN round((r_score + f_score + m_score) / 3.0, 2) >= 4.0 THEN 'High Value'
                    WHEN round((r_score + f_score + m_score) / 3.0, 2) >= 2.5 THEN 'Mid Value' ELSE 'Low Value' END AS clv_tier,
               CASE WHEN r_score <= 2 AND f_score <= 2 THEN 'High' WHEN r_score <= 3 THEN 'Medium' ELSE 'Low' END AS churn_risk
        FROM rfm_scored s LEFT JOIN dim_customers USING (customer_id)""",
    "structuring_daily": """
        SELECT customer_id, transaction_date, count(*) AS txn_count, sum(amount_gbp) AS daily_total_gbp,
               max(amount_gbp) AS largest_txn_gbp, min(amount_gbp) AS smallest_txn_gbp
        FROM fact_transactions WHERE transaction_type = 'Credit' AND amount_gbp BETWEEN 7500 AND 9999
        GROUP BY ALL""",
    "rolling_rows": """
        SELECT *, sum(daily_total_gbp) OVER w AS rolling_total, sum(txn_count) OVER w AS rolling_count
        FROM structuring_daily
        WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_date ROWS 6 PRECEDING)""",
    "rolling_days": """
        SELECT *, sum(daily_total_gbp) OVER w AS rolling_total, sum(txn_count) OVER w AS rolling_count
        FROM structuring_daily
        WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_date RANGE INTERVAL 6 DAYS PRECEDING)""",
    "spend_days": f"""
        SELECT customer_id, transaction_date, sum(amount_gbp) AS daily_spend, count(*) AS txn_count
        FROM fact_transactions WHERE transaction_type = 'Debit' AND transaction_date >= {AS_OF} - 90
        AND transaction_date <= {AS_OF} GROUP BY ALL""",
    "baseline": f"""
        SELECT customer_id, sum(daily_spend) AS past_total, count(*) AS past_days,
               sum(daily_spend)::double / count(*) AS avg_spend, stddev_samp(daily_spend::double) AS sd_spend,
               quantile_disc(daily_spend, 0.75) AS p75, quantile_disc(daily_spend, 0.95) AS p95
        FROM spend_days WHERE transaction_date <= {AS_OF} - 8 GROUP BY customer_id""",
    "velocity": f"""
        SELECT customer_id, transaction_date, daily_spend, past_total, past_days, p95, txn_count,
               round((daily_spend::double - avg_spend) / nullif(sd_spend, 0), 2) AS z_score,
               {_rounded('daily_spend * 100 * past_days', 'past_total * 100', 1)} AS spend_multiplier,
               daily_spend::double / avg_spend AS ratio
        FROM spend_days JOIN baseline USING (customer_id)
        WHERE transaction_date >= {AS_OF} - 7 AND daily_spend > p95 AND daily_spend::double > 3 * avg_spend AND avg_spend > 0""",
    "round_groups": f"""
        SELECT customer_id, amount_gbp, count(*) AS n, min(transaction_date) AS first_seen, max(transaction_date) AS last_seen,
               sum(amount_gbp) AS total, count(DISTINCT merchant_name) AS merchants
        FROM fact_transactions
        WHERE transaction_date >= {AS_OF} - 30 AND amount_gbp >= 500 AND amount_gbp < 10000
          AND round(amount_gbp, 0)::bigint % 100 = 0
        GROUP BY customer_id, amount_gbp HAVING count(*) >= 5""",
    "exposure": f"""
        SELECT customer_id, count(*) FILTER (abroad) AS foreign_txns,
               coalesce(sum(amount_gbp) FILTER (abroad), 0) AS foreign_gbp,
               count(*) FILTER (risky) AS high_risk_category_txns,
               coalesce(sum(amount_gbp) FILTER (risky), 0) AS high_risk_category_gbp,
               count(*) FILTER (abroad AND risky) AS foreign_high_risk_txns
        FROM (SELECT *, merchant_country <> 'GB' AS abroad, coalesce(is_high_risk, false) AS risky
              FROM fact_transactions LEFT JOIN ref_merchant_categories ON mcc_code = merchant_category_code
              WHERE transaction_date >= {AS_OF} - 30)
        WHERE abroad OR risky GROUP BY customer_id""",
    "geo_moves": f"""
        SELECT c.*, customer_segment, lag(country) OVER (PARTITION BY customer_id ORDER BY day, country) AS previous,
               day - lag(day) OVER (PARTITION BY customer_id ORDER BY day, country) AS days_since
        FROM (SELECT customer_id, transaction_date AS day, merchant_country AS country, count(*) AS payments, sum(amount_gbp) AS amount
              FROM fact_transactions WHERE transaction_date >= {AS_OF} - 365 AND merchant_country IS NOT NULL GROUP BY ALL) c
        JOIN (SELECT customer_id, customer_segment FROM dim_customers) USING (customer_id)""",
    "geo_steps": f"""
        SELECT day, customer_segment, CASE WHEN days_since = 0 THEN 'same day' WHEN days_since <= 3 THEN '1-3 days'
                                           WHEN days_since <= 14 THEN '4-14 days' ELSE '15+ days' END AS gap,
               previous, country, 1 AS n FROM geo_moves WHERE previous IS NOT NULL
        UNION ALL SELECT day, customer_segment, 'same day', country, country, payments - 1 FROM geo_moves WHERE payments > 1""",
    "geo_scored": f"""
        SELECT m.*, (coalesce((SELECT sum(n) FROM geo_steps l WHERE l.day < {AS_OF} - 30 AND l.customer_segment = m.customer_segment AND l.gap = m.gap
                               AND l.previous = m.previous AND l.country = m.country), 0)::double
                     + 10.0::double * ((coalesce(p.n, 0)::double * 249.0::double + 1.0::double)
                                       / ((coalesce(t.n, 0)::double + 1.0::double) * 249.0::double)))
                    / (coalesce(s.n, 0)::double + 10.0::double) AS probability
        FROM (SELECT *, CASE WHEN days_since = 0 THEN 'same day' WHEN days_since <= 3 THEN '1-3 days'
                             WHEN days_since <= 14 THEN '4-14 days' ELSE '15+ days' END AS gap
              FROM geo_moves WHERE previous IS NOT NULL AND day >= {AS_OF} - 30) m
        LEFT JOIN (SELECT customer_segment, gap, previous, sum(n) AS n FROM geo_steps WHERE day < {AS_OF} - 30 GROUP BY ALL) s
               USING (customer_segment, gap, previous)
        LEFT JOIN (SELECT customer_segment, country, sum(payments) AS n FROM geo_moves WHERE day < {AS_OF} - 30 GROUP BY ALL) p
               USING (customer_segment, country)
        LEFT JOIN (SELECT customer_segment, sum(payments) AS n FROM geo_moves WHERE day < {AS_OF} - 30 GROUP BY ALL) t
               USING (customer_segment)""",
    "holdings": """
        SELECT customer_id, string_agg(DISTINCT product_type, ',' ORDER BY product_type) AS held_products,
               bool_or(product_type = 'Current Account') AS has_current_account,
               bool_or(product_type = 'Savings') AS has_savings, bool_or(product_type = 'Credit Card') AS has_credit_card,
               bool_or(product_type = 'Mortgage') AS has_mortgage, bool_or(product_type = 'Loan') AS has_loan,
               count(DISTINCT product_type) AS product_count, sum(abs(balance_gbp)) AS total_balance_gbp
        FROM fact_accounts JOIN dim_products USING (product_id)
        WHERE account_status = 'Active' AND snapshot_month = DATE '2024-12-01' GROUP BY customer_id""",
    "behaviour": """
        SELECT customer_id, sum(amount_gbp) AS total_spend_6m, sum(amount_gbp)::double / count(amount_gbp) AS avg_txn_amount,
               count(*) FILTER (transaction_category = 'Mortgage/Rent') AS rent_payments,
               count(*) FILTER (transaction_category IN ('International', 'FX')) AS intl_transactions,
               count(*) FILTER (merchant_country <> 'GB') AS foreign_txns, count(*) AS total_txns
        FROM fact_transactions
        WHERE transaction_date >= DATE '2024-06-30' AND transaction_type = 'Debit' AND NOT is_flagged GROUP BY customer_id""",
    "eligible": """
        SELECT c.customer_id, customer_segment, age_band, region, risk_rating, tenure_years, h.* EXCLUDE (customer_id),
               total_spend_6m, avg_txn_amount, rent_payments, intl_transactions, foreign_txns, total_txns
        FROM dim_customers c JOIN holdings h USING (customer_id) LEFT JOIN behaviour USING (customer_id)
        WHERE kyc_status = 'Verified' AND risk_rating IN ('Low', 'Medium') AND has_current_account""",
    "opportunities": """
        SELECT *, NOT has_savings AND total_balance_gbp > 2000 AND customer_segment IN ('Retail', 'Premier') AS s,
               coalesce(NOT has_credit_card AND total_spend_6m > 1500 AND tenure_years >= 1 AND age_band <> '18-24'
                        AND risk_rating = 'Low', false) AS c,
               coalesce(NOT has_mortgage AND rent_payments >= 4 AND age_band IN ('25-34', '35-44')
                        AND customer_segment IN ('Premier', 'Private') AND total_balance_gbp > 10000, false) AS m,
               coalesce(intl_transactions > 10 AND NOT has_credit_card, false) AS t
        FROM eligible""",
    "account_rows": """
        SELECT a.*, product_type, product_family, region, customer_segment
        FROM fact_accounts a JOIN dim_products USING (product_id) JOIN dim_customers USING (customer_id)""",
    "interest": """
        SELECT snapshot_month, product_type, product_family, region, customer_segment,
               sum(interest_charged_gbp) AS income, sum(interest_earned_gbp) AS cost
        FROM account_rows GROUP BY ALL""",
    "fees": """
        SELECT date_trunc('month', transaction_date)::date AS snapshot_month, product_type, product_family, region,
               customer_segment, sum(fees_charged_gbp) AS fee
        FROM account_rows a JOIN fact_transactions t ON t.customer_id = a.customer_id
         AND t.transaction_date >= a.snapshot_month AND t.transaction_date <= last_day(a.snapshot_month)
        GROUP BY ALL""",
    "counts": """
        SELECT snapshot_month, product_type, region, customer_segment, count(DISTINCT account_id) AS accounts,
               count(DISTINCT customer_id) AS customers, count(*) FILTER (days_in_arrears > 0) AS arrears,
               sum(balance_gbp) AS balance, count(balance_gbp) AS balances, sum(abs(balance_gbp)) AS book
        FROM account_rows WHERE account_status = 'Active' GROUP BY ALL""",
    "pnl": f"""
        SELECT *, coalesce(fee, 0) AS fee0, income - cost AS net, income - cost + coalesce(fee, 0) AS revenue,
               {_rounded('(income - cost) * 120000', 'book * 100', 3)} AS nim,
               {_rounded('arrears * 100', 'accounts', 2)} AS arrears_rate
        FROM interest LEFT JOIN (SELECT * EXCLUDE (product_family) FROM fees) USING (snapshot_month, product_type, region, customer_segment)
        LEFT JOIN counts USING (snapshot_month, product_type, region, customer_segment)""",
    "txn_features": """
        SELECT customer_id, count(*) AS n, sum(amount_gbp) AS spend, sum(amount_gbp)::double / count(amount_gbp) AS mean,
               stddev_samp(amount_gbp::double) AS sd, count(DISTINCT transaction_category) AS categories,
               count(DISTINCT merchant_name) AS merchants, count(DISTINCT date_trunc('month', transaction_date)) AS months,
               count(*) FILTER (channel = 'Mobile') AS mobile, count(*) FILTER (channel = 'Branch') AS branch,
               count(*) FILTER (channel = 'ATM') AS atm, count(*) FILTER (is_international) AS intl,
               date_diff('day', max(transaction_date), DATE '2024-12-31') AS gap,
               coalesce(sum(amount_gbp) FILTER (transaction_date >= DATE '2024-09-30'), 0) AS late,
               coalesce(sum(amount_gbp) FILTER (transaction_date < DATE '2024-09-30'), 0) AS early
        FROM fact_transactions
        WHERE transaction_date >= DATE '2024-06-30' AND transaction_type = 'Debit' AND NOT is_flagged GROUP BY customer_id""",
    "account_features": """
        SELECT customer_id, count(DISTINCT account_id) AS products, sum(utilisation_pct)::double / nullif(count(utilisation_pct), 0) AS utilisation,
               max(days_in_arrears) AS worst, sum(missed_payments_3m) AS missed, sum(fees_charged_gbp) AS fees,
               sum(balance_gbp)::double / count(balance_gbp) AS balance,
               count(*) FILTER (account_status = 'Overdrawn') AS overdrawn, count(*) FILTER (account_status = 'Dormant') AS dormant
        FROM fact_accounts WHERE snapshot_month >= DATE '2024-06-30' AND account_status <> 'Closed' GROUP BY customer_id""",
    "labels_any": """
        SELECT customer_id, max((account_status = 'Closed' AND coalesce(closed_date BETWEEN DATE '2024-12-31' AND DATE '2025-03-31', false))::int)
               AS churned
        FROM fact_accounts GROUP BY customer_id""",
    "features": """
        SELECT customer_id, 2024 - year(date_of_birth) AS age, tenure_years, customer_segment, region, risk_rating,
               coalesce(n, 0) AS txn_count_6m, coalesce(spend, 0)::double AS total_spend_6m,
               coalesce(mean, 0) AS avg_txn_amount_6m, coalesce(categories, 0) AS unique_categories,
               coalesce(merchants, 0) AS unique_merchants, coalesce(months, 0) AS active_months_6m,
               coalesce(gap, 999) AS days_since_last_txn, coalesce(mobile, 0) AS mobile_txns,
               coalesce(branch, 0) AS branch_txns, coalesce(intl, 0) AS intl_txns,
               coalesce((late - early)::double / nullif(early, 0)::double, 0) AS spend_trend_pct,
               coalesce(products, 0) AS product_count, coalesce(utilisation, 0) AS avg_credit_utilisation,
               coalesce(worst, 0) AS max_days_in_arrears, coalesce(missed, 0)::bigint AS total_missed_payments_3m,
               coalesce(fees, 0)::double AS total_fees_charged_6m, coalesce(balance, 0) AS avg_balance,
               coalesce(overdrawn, 0) AS overdrawn_accounts, coalesce(dormant, 0) AS dormant_accounts,
               nps_score, coalesce(churned, 0)::bigint AS churned
        FROM dim_customers LEFT JOIN txn_features USING (customer_id) LEFT JOIN account_features USING (customer_id)
        LEFT JOIN labels_any USING (customer_id)
        WHERE kyc_status = 'Verified'""",
    "declared_scores": """
        SELECT *, round(1 / (1 + exp(-(-1.5 + 0.01 * age - 0.08 * tenure_years - 0.05 * txn_count_6m + 0.02 * days_since_last_txn
                 - 0.2 * product_count + 0.03 * max_days_in_arrears - 0.004 * nps_score
                 + CASE customer_segment WHEN 'Retail' THEN 0.3 WHEN 'Private' THEN -0.4 ELSE 0 END
                 + CASE region WHEN 'ASIA' THEN 0.25 WHEN 'EUROPE' THEN -0.15 ELSE 0 END)::double)), 9) AS p,
               held_out
        FROM (SELECT *, ('0x' || substr(md5(customer_id), 1, 15))::bigint % 1000 < 200 AS held_out FROM features)""",
}


def _sql(body: str, star_given: bool = False) -> str:
    """Put the steps and tables the query needs in front of it, in definition order."""
    needed: set[str] = set()
    parts = STEPS if star_given else {**STAR, **STEPS}

    def visit(text: str) -> None:
        words = set(re.findall(r"[a-z_0-9]+", text))
        for name, definition in parts.items():
            if name in words and name not in needed:
                needed.add(name)
                visit(definition)

    visit(body)
    ctes = ", ".join(f"{name} AS ({text})" for name, text in parts.items() if name in needed)
    return f"WITH {ctes} {body}" if ctes else body


_RFM_DATES = "recency_days, frequency_months, monetary_gbp::double AS monetary_gbp, total_transactions, unique_merchants, " \
             "last_transaction_date::varchar AS last_transaction_date, first_transaction_date::varchar AS first_transaction_date"

_SEGMENTS = f"""SELECT customer_id, {_RFM_DATES}, r_score, f_score, m_score, rfm_composite_score::double AS rfm_composite_score,
    rfm_segment, customer_segment, region, age_band, risk_rating, customer_since::varchar AS customer_since, tenure_years,
    clv_tier, churn_risk FROM rfm_segments"""


#: credits and debits as intervals of the money received so far, joined where they overlap
_LAYERING = """
    WITH flows AS (
      SELECT customer_id, transaction_date AS day, sum(CASE WHEN transaction_type = 'Credit' THEN amount_gbp ELSE 0 END) AS credits,
             sum(CASE WHEN transaction_type = 'Debit' THEN amount_gbp ELSE 0 END) AS debits
      FROM fact_transactions WHERE transaction_type IN ('Credit', 'Debit') AND amount_gbp > 0 GROUP BY ALL),
    totals AS (SELECT *, sum(credits) OVER w AS paid_in, sum(debits) OVER w AS paid_out FROM flows
               WINDOW w AS (PARTITION BY customer_id ORDER BY day)),
    spending AS (SELECT *, paid_out + least(0, min(paid_in - paid_out) OVER (PARTITION BY customer_id ORDER BY day)) AS used FROM totals),
    lines AS (SELECT *, lag(used, 1, 0) OVER (PARTITION BY customer_id ORDER BY day) AS used_before FROM spending),
    matched AS (
      SELECT c.customer_id, c.day, least(c.paid_in, d.used) - greatest(c.paid_in - c.credits, d.used_before) AS size
      FROM lines c JOIN lines d ON c.customer_id = d.customer_id AND d.used > c.paid_in - c.credits AND d.used_before < c.paid_in
      WHERE c.credits > 0 AND d.used > d.used_before AND d.day - c.day <= 3)
    SELECT f.customer_id, f.day, any_value(f.credits) AS credits, coalesce(sum(size), 0) AS passed
    FROM flows f LEFT JOIN matched o ON o.customer_id = f.customer_id AND o.day = f.day WHERE f.credits > 0 GROUP BY ALL"""


def _structuring(step: str) -> str:
    severity = """CASE WHEN rolling_count >= 5 AND rolling_total > 40000 THEN 'Critical'
        WHEN rolling_count >= 3 AND rolling_total > 25000 THEN 'High'
        WHEN rolling_count >= 2 AND rolling_total > 15000 THEN 'Medium' ELSE 'Low' END"""
    return f"""SELECT customer_id, customer_segment, risk_rating, region, transaction_date::varchar AS transaction_date,
        txn_count, daily_total_gbp::double AS daily_total_gbp, rolling_total::double AS rolling_7d_total_gbp,
        rolling_count::bigint AS rolling_7d_txn_count, {severity} AS alert_severity, 'Structuring - Sub-threshold credits' AS alert_type
        FROM {step} JOIN dim_customers USING (customer_id) WHERE rolling_count >= 2 AND rolling_total > 10000"""


def _round_amount(extra: str) -> str:
    severity = "CASE WHEN n >= 10 AND total > 50000 THEN 'High' WHEN n >= 5 AND total > 20000 THEN 'Medium' ELSE 'Low' END"
    return f"""SELECT customer_id, amount_gbp::double AS amount_gbp, n AS frequency_30d, first_seen::varchar AS first_seen,
        last_seen::varchar AS last_seen, total::double AS total_exposure_gbp, merchants AS distinct_merchants,
        'Round-amount repetition' AS alert_type, {severity} AS alert_severity FROM round_groups {extra}"""


_GROUP = "snapshot_month::varchar AS snapshot_month, product_type, product_family, region, customer_segment"

_PNL = f"""SELECT {_GROUP}, accounts AS active_accounts, customers AS active_customers,
    round(book, 0)::double AS total_book_gbp, {_rounded('balance * 100', 'balances * 100', 2)}::double AS avg_balance_gbp,
    round(net, 0)::double AS net_interest_income_gbp, round(income, 0)::double AS gross_interest_income_gbp,
    round(cost, 0)::double AS interest_cost_gbp, round(fee0, 0)::double AS fee_income_gbp,
    round(revenue, 0)::double AS total_revenue_gbp, arrears AS accounts_in_arrears, arrears_rate::double AS arrears_rate_pct,
    nim::double AS nim_annualised_pct,
    round(revenue - lag(revenue) OVER (PARTITION BY product_type, region, customer_segment ORDER BY snapshot_month), 0)::double
        AS mom_revenue_delta_gbp
    FROM pnl"""

_EXEC = f"""SELECT '2024-12-31' AS report_month, '2024-12-31 00:00:00' AS inserted_at, sum(round(revenue, 0))::double AS total_revenue_gbp,
    sum(round(net, 0))::double AS total_nii_gbp, sum(round(fee0, 0))::double AS total_fee_income_gbp,
    sum(customers)::bigint AS total_active_customers, sum(accounts)::bigint AS total_active_accounts,
    sum(round(book, 0))::double AS total_book_gbp, sum(nim)::double / count(nim) AS avg_nim_pct,
    sum(arrears_rate)::double / count(arrears_rate) AS avg_arrears_rate_pct
    FROM pnl WHERE snapshot_month = DATE '2024-12-01'"""


def _bucket(text: str, size: int) -> str:
    return f"(('0x' || substr(md5(({text})::varchar), 1, 15))::bigint % {size})"


def _generated_customers() -> str:
    return f"""
    SELECT 'CUST' || {_ID} AS customer_id, 'First' || k AS first_name, 'Last' || k AS last_name,
           dob::varchar AS date_of_birth,
           CASE WHEN years BETWEEN 18 AND 24 THEN '18-24' WHEN years BETWEEN 25 AND 34 THEN '25-34'
                WHEN years BETWEEN 35 AND 44 THEN '35-44' WHEN years BETWEEN 45 AND 54 THEN '45-54'
                WHEN years BETWEEN 55 AND 64 THEN '55-64' ELSE '65+' END AS age_band,
           CASE {_bucket('k * 17', 2)} WHEN 0 THEN 'M' ELSE 'F' END AS gender,
           place.postcode AS postcode_district, place.region AS region, 'GB' AS country, since::varchar AS customer_since,
           CASE WHEN seg < 70 THEN 'Retail' WHEN seg < 92 THEN 'Premier' ELSE 'Private' END AS customer_segment,
           seg < 15 AS is_student, false AS is_business, 'Verified' AS kyc_status,
           CASE WHEN risk < 75 THEN 'Low' WHEN risk < 93 THEN 'Medium' ELSE 'High' END AS risk_rating,
           'RM_' || lpad((k % 500)::varchar, 4, '0') AS relationship_mgr,
           {_bucket('k * 23', 201)} - 100 AS nps_score,
           strftime(since, '%Y-%m-%d %H:%M:%S') AS created_at, '2024-12-31 00:00:00' AS updated_at
    FROM (SELECT k, ([{{'region': 'London', 'postcode': 'SW1'}}, {{'region': 'London', 'postcode': 'EC1'}},
                      {{'region': 'South East', 'postcode': 'RG1'}}, {{'region': 'North West', 'postcode': 'M1'}},
                      {{'region': 'Yorkshire', 'postcode': 'LS1'}}, {{'region': 'Scotland', 'postcode': 'EH1'}},
                      {{'region': 'Midlands', 'postcode': 'B1'}}, {{'region': 'South West', 'postcode': 'BS1'}}])[1 + {_bucket('k * 7', 8)}] AS place, {_bucket('k * 11', 100)} AS seg,
                 {_bucket('k * 13', 100)} AS risk, 20 + {_bucket('k', 45)} AS years,
                 ({AS_OF} - to_years((20 + {_bucket('k', 45)})::int))::date AS dob,
                 ({AS_OF} - to_years((1 + {_bucket('k * 3', 15)})::int))::date AS since
          FROM (SELECT c_custkey AS k FROM customer))"""


# fixed values
_HOLIDAYS = """DATE '2022-01-03', DATE '2022-04-15', DATE '2022-04-18', DATE '2022-05-02', DATE '2022-06-02',
    DATE '2022-06-03', DATE '2022-08-29', DATE '2022-09-19', DATE '2022-12-26', DATE '2022-12-27', DATE '2023-01-02',
    DATE '2023-04-07', DATE '2023-04-10', DATE '2023-05-01', DATE '2023-05-08', DATE '2023-05-29', DATE '2023-08-28',
    DATE '2023-12-25', DATE '2023-12-26', DATE '2024-01-01', DATE '2024-03-29', DATE '2024-04-01', DATE '2024-05-06',
    DATE '2024-05-27', DATE '2024-08-26', DATE '2024-12-25', DATE '2024-12-26'"""

QUERIES = {
    # ---- tables
    "dim_date": f"""
        SELECT d::varchar AS date_id, year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
               weekofyear(d) AS week_of_year, dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_name,
               dayofweek(d) IN (0, 6) AS is_weekend, d IN ({_HOLIDAYS}) AS is_uk_bank_holiday, year(d) AS fiscal_year,
               'FY' || year(d) || '-Q' || quarter(d) AS fiscal_quarter, count(transaction_id) AS transactions
        FROM (SELECT unnest(generate_series(DATE '2022-01-01', DATE '2024-12-31', INTERVAL 1 DAY))::date AS d)
        LEFT JOIN fact_transactions ON transaction_date = d GROUP BY d""",
    "dim_products": """
        SELECT product_id, product_code, product_name, product_type, product_family, interest_rate::double AS interest_rate,
               fee_monthly::double AS fee_monthly, credit_limit_max::double AS credit_limit_max, is_active,
               launch_date::varchar AS launch_date, count(DISTINCT account_id) AS accounts
        FROM dim_products JOIN fact_accounts USING (product_id) GROUP BY ALL""",
    "dim_customers": _generated_customers(),
    "star_customers": """
        SELECT customer_id, date_of_birth::varchar AS date_of_birth, age_band, region, customer_since::varchar AS customer_since,
               customer_segment, kyc_status, risk_rating, nps_score FROM dim_customers""",
    "star_transactions": """
        SELECT transaction_id, customer_id, account_id, product_id, transaction_date::varchar AS transaction_date, transaction_type,
               transaction_category, merchant_name, merchant_category_code, merchant_country, amount_gbp::double AS amount_gbp,
               channel, is_international, is_flagged FROM fact_transactions""",
    "star_accounts": """
        SELECT account_id, customer_id, product_id, snapshot_month::varchar AS snapshot_month, account_status,
               balance_gbp::double AS balance_gbp, utilisation_pct::double AS utilisation_pct, days_in_arrears, missed_payments_3m,
               interest_charged_gbp::double AS interest_charged_gbp, interest_earned_gbp::double AS interest_earned_gbp,
               fees_charged_gbp::double AS fees_charged_gbp, closed_date::varchar AS closed_date FROM fact_accounts""",
    # ---- segmentation
    "rfm_raw": f"SELECT customer_id, {_RFM_DATES} FROM rfm_raw",
    "rfm_scored": f"SELECT customer_id, {_RFM_DATES}, r_score, f_score, m_score FROM rfm_scored",
    "rfm_segments": _SEGMENTS,
    "mv_customer_rfm": _SEGMENTS.replace("churn_risk FROM", "churn_risk, '2024-12-31 00:00:00' AS computed_at FROM"),
    "mv_customer_rfm_next_day": _SEGMENTS.replace("churn_risk FROM", "churn_risk, '2024-12-31 00:00:00' AS computed_at FROM"),
    "rfm_segment_summary": """
        SELECT rfm_segment, sum(n)::bigint AS customers, sum(spend)::double / sum(n) AS avg_monetary_gbp,
               arg_min(churn_risk, (-n, churn_risk)) AS churn_risk
        FROM (SELECT rfm_segment, churn_risk, count(*) AS n, sum(monetary_gbp) AS spend FROM rfm_segments GROUP BY ALL)
        GROUP BY rfm_segment""",
    # ---- churn
    "churn_labels": "SELECT customer_id, churned::bigint AS churned FROM labels_any",
    "churn_labels_all_closed": """
        SELECT customer_id, min(closing)::bigint AS churned
        FROM (SELECT customer_id, account_id, max((account_status = 'Closed' AND
                     coalesce(closed_date BETWEEN DATE '2024-12-31' AND DATE '2025-03-31', false))::int) AS closing
              FROM fact_accounts GROUP BY ALL) GROUP BY customer_id""",
    "churn_txn_features": """
        SELECT customer_id, n AS txn_count_6m, spend::double AS total_spend_6m, mean AS avg_txn_amount_6m,
               round(sd, 4) AS stddev_txn_amount, categories AS unique_categories, merchants AS unique_merchants,
               months AS active_months, mobile AS mobile_txns, branch AS branch_txns, atm AS atm_txns, intl AS intl_txns,
               gap AS days_since_last_txn, late::double AS spend_last_3m, early::double AS spend_prior_3m FROM txn_features""",
    "churn_account_features": """
        SELECT customer_id, products AS product_count, utilisation AS avg_credit_utilisation, worst AS max_days_in_arrears,
               missed::bigint AS total_missed_payments_3m, fees::double AS total_fees_charged_6m, balance AS avg_balance,
               overdrawn AS overdrawn_accounts, dormant AS dormant_accounts FROM account_features""",
    "ml_churn_features": "SELECT * FROM features",
    "churn_training_set": f"""
        SELECT customer_id, churned, held_out, total::double / (2 * class_size) AS class_weight
        FROM (SELECT customer_id, churned, {_bucket('customer_id', 1000)} < 200 AS held_out,
                     count(*) FILTER ({_bucket('customer_id', 1000)} >= 200) OVER () AS total,
                     count(*) FILTER ({_bucket('customer_id', 1000)} >= 200) OVER (PARTITION BY churned) AS class_size
              FROM features)""",
    "churn_scores": """
        SELECT penalty, customer_id, customer_segment, region, tenure_years, days_since_last_txn, product_count,
               true AS probability_agrees, true AS decision_agrees FROM features CROSS JOIN (VALUES ('default'), ('light')) v(penalty)""",
    "churn_evaluate": """
        SELECT penalty, rows, true AS precision_agrees, true AS recall_agrees, true AS accuracy_agrees, true AS f1_score_agrees,
               true AS log_loss_agrees, true AS roc_auc_agrees
        FROM (VALUES ('default'), ('light')) v(penalty) CROSS JOIN (VALUES ('all'), ('held_out')) w(rows)""",
    "churn_scores_declared": """
        SELECT customer_id, customer_segment, region, tenure_years, days_since_last_txn, product_count, p AS churn_probability,
               CASE WHEN p > 0.5 THEN 1 ELSE 0 END::bigint AS predicted_churned,
               CASE WHEN p >= 0.75 THEN 'Imminent (75%+)' WHEN p >= 0.50 THEN 'High Risk (50-75%)'
                    WHEN p >= 0.25 THEN 'At Risk (25-50%)' ELSE 'Low Risk (<25%)' END AS churn_tier
        FROM declared_scores""",
    "churn_evaluate_declared": """
        SELECT rows, round(coalesce(hit / nullif(guessed, 0), 0), 6) AS precision, round(coalesce(hit / nullif(positive, 0), 0), 6) AS recall,
               round(correct / n, 6) AS accuracy, round(coalesce(2 * hit / nullif(guessed + positive, 0), 0), 6) AS f1_score,
               round(log_loss, 6) AS log_loss, round((rank_sum - positive * (positive + 1) / 2) / (positive * (n - positive)), 6) AS roc_auc
        FROM (SELECT rows, count(*)::double AS n, sum(churned)::double AS positive, sum((p > 0.5)::int)::double AS guessed,
                     sum((p > 0.5 AND churned = 1)::int)::double AS hit, sum(((p > 0.5) = (churned = 1))::int)::double AS correct,
                     avg(-ln(greatest(CASE WHEN churned = 1 THEN p ELSE 1 - p END, 1e-15))) AS log_loss,
                     sum(CASE WHEN churned = 1 THEN middle_rank END) AS rank_sum
              FROM (SELECT *, rank() OVER (PARTITION BY rows ORDER BY p)
                              + (count(*) OVER (PARTITION BY rows, p) - 1) / 2.0::double AS middle_rank
                    FROM (SELECT 'all' AS rows, * FROM declared_scores
                          UNION ALL SELECT 'held_out', * FROM declared_scores WHERE held_out))
              GROUP BY rows)""",
    # the fits themselves have no SQL; these say what must hold for them
    "churn_train": """
        SELECT penalty, 17 + (SELECT count(DISTINCT customer_segment) + 1 + count(DISTINCT region) + 1 FROM features) AS inputs,
               found_weights, true AS optimal
        FROM (VALUES ('default', NULL), ('light', true)) v(penalty, found_weights)""",
    "churn_weights": """
        SELECT processed_input, planted_sign::bigint AS planted_sign, true AS optimal
        FROM (SELECT unnest(['txn_count_6m', 'total_spend_6m', 'avg_txn_amount_6m', 'unique_categories', 'active_months_6m',
                             'days_since_last_txn', 'mobile_txns', 'spend_trend_pct', 'product_count', 'avg_credit_utilisation',
                             'max_days_in_arrears', 'total_missed_payments_3m', 'overdrawn_accounts', 'dormant_accounts', 'nps_score',
                             'customer_segment___unknown', 'region___unknown', '__intercept__']) AS processed_input, NULL AS planted_sign
              UNION ALL SELECT * FROM (VALUES ('age', 1), ('tenure_years', -1))
              UNION ALL SELECT DISTINCT 'customer_segment_' || customer_segment, NULL FROM features
              UNION ALL SELECT DISTINCT 'region_' || region, NULL FROM features)""",
    # ---- cross-sell
    "product_holdings": """
        SELECT customer_id, held_products, has_current_account, has_savings, has_credit_card, has_mortgage, has_loan,
               product_count, total_balance_gbp::double AS total_balance_gbp FROM holdings""",
    "cross_sell_behaviour": """
        SELECT customer_id, total_spend_6m::double AS total_spend_6m, avg_txn_amount, rent_payments, intl_transactions,
               foreign_txns, total_txns FROM behaviour""",
    "cross_sell_eligible": """
        SELECT * REPLACE (total_balance_gbp::double AS total_balance_gbp, total_spend_6m::double AS total_spend_6m)
        FROM eligible""",
    "cross_sell": f"""
        SELECT customer_id, customer_segment, region, age_band, risk_rating, product_count,
               round(total_balance_gbp, 0)::double AS total_balance_gbp, round(total_spend_6m, 0)::double AS total_spend_6m,
               s AS opportunity_savings, c AS opportunity_credit_card, m AS opportunity_mortgage, t AS opportunity_travel_card,
               (s::int + c::int + m::int + t::int)::bigint AS opportunity_count,
               CASE WHEN m THEN 'Residential Mortgage' WHEN c THEN 'Cashback Credit Card' WHEN s THEN 'Fixed Rate Bond 12M'
                    WHEN t THEN 'Platinum Credit Card' ELSE 'None' END AS recommended_product
        FROM opportunities WHERE s OR c OR m OR t""",
    # ---- money laundering
    "structuring_daily": """
        SELECT customer_id, transaction_date::varchar AS transaction_date, txn_count, daily_total_gbp::double AS daily_total_gbp,
               largest_txn_gbp::double AS largest_txn_gbp, smallest_txn_gbp::double AS smallest_txn_gbp FROM structuring_daily""",
    "structuring_transaction_ids": """
        SELECT customer_id, transaction_date::varchar AS transaction_date, transaction_id
        FROM fact_transactions WHERE transaction_type = 'Credit' AND amount_gbp BETWEEN 7500 AND 9999""",
    "rolling_7d_sum": """
        SELECT customer_id, transaction_date::varchar AS transaction_date, rolling_total::double AS rolling_7d_total_gbp,
               rolling_count::bigint AS rolling_7d_txn_count FROM rolling_rows""",
    "aml_structuring_alerts": _structuring("rolling_rows"),
    "aml_structuring_calendar": _structuring("rolling_days"),
    "aml_layering_daily": f"""
        SELECT customer_id, day::varchar AS transaction_date, credits::double AS credits_gbp, passed::double AS passed_on_gbp,
               {_rounded('passed * 10000', 'credits * 100', 2)}::double AS passed_on_pct FROM ({_LAYERING})""",
    "aml_layering": f"""
        SELECT customer_id, customer_segment, risk_rating, region, day::varchar AS transaction_date, credits::double AS credits_gbp,
               passed::double AS passed_on_gbp, {_rounded('passed * 10000', 'credits * 100', 2)}::double AS passed_on_pct,
               'Layering - Credits passed on' AS alert_type
        FROM ({_LAYERING}) JOIN dim_customers USING (customer_id) WHERE credits >= 5000 AND passed >= 0.8 * credits""",
    "velocity_baseline": """
        SELECT customer_id, avg_spend AS avg_daily_spend, round(sd_spend, 4) AS stddev_daily_spend,
               p75::double AS p75_daily_spend, p95::double AS p95_daily_spend FROM baseline""",
    "aml_velocity_alerts": f"""
        SELECT customer_id, transaction_date::varchar AS transaction_date, daily_spend::double AS todays_spend_gbp,
               {_rounded('past_total * 100', 'past_days * 100', 2)}::double AS avg_daily_spend_gbp,
               p95::double AS p95_daily_spend_gbp, txn_count, z_score, spend_multiplier::double AS spend_multiplier,
               CASE WHEN ratio > 10 THEN 'Critical' WHEN ratio > 5 THEN 'High' WHEN ratio > 3 THEN 'Medium' ELSE 'Low' END
                   AS alert_severity,
               'Velocity - Unusual daily spend spike' AS alert_type FROM velocity""",
    "aml_round_amount_alerts": _round_amount(""),
    "aml_round_amount_exact": _round_amount("WHERE amount_gbp % 100 = 0"),
    "aml_high_risk_exposure": """
        SELECT * REPLACE (foreign_gbp::double AS foreign_gbp, high_risk_category_gbp::double AS high_risk_category_gbp)
        FROM exposure""",
    "geo_transitions": """
        SELECT customer_segment, gap, previous AS previous_country, country AS merchant_country, sum(n)::bigint AS moves
        FROM geo_steps GROUP BY ALL""",
    "geo_scores": """
        SELECT customer_id, customer_segment, day::varchar AS transaction_date, previous AS previous_country,
               country AS merchant_country, gap, days_since::bigint AS days_since, payments, amount::double AS amount_gbp, probability
        FROM geo_scored""",
    "aml_geographic_anomaly": """
        SELECT customer_id, customer_segment, day::varchar AS transaction_date, previous AS previous_country,
               country AS merchant_country, gap, payments, amount::double AS amount_gbp, probability,
               'Geographic anomaly' AS alert_type FROM geo_scored WHERE probability < 0.1""",
    "aml_flag_summary": f"""
        SELECT alert_type, count(*) AS alerts, sum(n)::bigint AS transactions, sum(value)::double AS value_gbp
        FROM (SELECT 'Structuring - Sub-threshold credits' AS alert_type, txn_count AS n, daily_total_gbp AS value
              FROM rolling_rows JOIN dim_customers USING (customer_id)
              WHERE rolling_count >= 2 AND rolling_total > 10000 AND transaction_date >= {AS_OF} - 30
              UNION ALL SELECT 'Velocity - Unusual daily spend spike', txn_count, daily_spend FROM velocity
              UNION ALL SELECT 'Round-amount repetition', n, total FROM round_groups
              UNION ALL SELECT 'Geographic anomaly', payments, amount FROM geo_scored WHERE probability < 0.1)
        GROUP BY alert_type""",
    # ---- mergeable state
    "active_customer_totals": """
        SELECT snapshot_month::varchar AS snapshot_month, 'group' AS level, product_type, region, customer_segment,
               count(DISTINCT customer_id) AS active_customers FROM account_rows WHERE account_status = 'Active' GROUP BY ALL
        UNION ALL SELECT snapshot_month::varchar, 'region', NULL, region, NULL, count(DISTINCT customer_id)
        FROM account_rows WHERE account_status = 'Active' GROUP BY ALL
        UNION ALL SELECT snapshot_month::varchar, 'bank', NULL, NULL, NULL, count(DISTINCT customer_id)
        FROM account_rows WHERE account_status = 'Active' GROUP BY ALL""",
    "accounts_by_period": f"""
        SELECT p::bigint AS period_days, channel, count(DISTINCT account_id) AS exact_accounts, true AS within_bounds
        FROM fact_transactions JOIN (VALUES (7), (30), (90), (365)) v(p)
             ON transaction_date BETWEEN {AS_OF} - (p - 1) AND {AS_OF} GROUP BY ALL""",
    "spend_baselines": f"""
        SELECT p::bigint AS period_days, customer_segment, q::double AS quantile, count(*) AS customer_days, true AS within_bound
        FROM (SELECT DISTINCT customer_id, transaction_date FROM fact_transactions WHERE transaction_type = 'Debit')
        JOIN (SELECT customer_id, customer_segment FROM dim_customers) USING (customer_id)
        JOIN (VALUES (7), (30), (90), (365)) v(p) ON transaction_date BETWEEN {AS_OF} - (p - 1) AND {AS_OF}
        CROSS JOIN (VALUES (0.5), (0.75), (0.95)) w(q) GROUP BY ALL""",
    # ---- profit and loss
    "pnl_net_interest": f"""
        SELECT {_GROUP}, income::double AS interest_income_gbp, cost::double AS interest_cost_gbp,
               (income - cost)::double AS net_interest_gbp FROM interest""",
    "pnl_fee_income": f"SELECT {_GROUP}, fee::double AS fee_income_gbp FROM fees",
    "pnl_fee_income_dedup": f"""
        SELECT {_GROUP}, sum(fees_charged_gbp)::double AS fee_income_gbp FROM account_rows
        WHERE (customer_id, snapshot_month) IN
              (SELECT (customer_id, date_trunc('month', transaction_date)::date) FROM fact_transactions) GROUP BY ALL""",
    "pnl_account_counts": """
        SELECT snapshot_month::varchar AS snapshot_month, product_type, region, customer_segment, accounts AS active_accounts,
               customers AS active_customers, arrears AS accounts_in_arrears, balance::double / balances AS avg_balance_gbp,
               book::double AS total_book_gbp FROM counts""",
    "v_monthly_pnl": _PNL,
    "monthly_pnl_one_month": f"SELECT * FROM ({_PNL}) WHERE snapshot_month = '2024-11-01'",
    "monthly_executive_summary": _EXEC,
    "executive_summary_from_base": f"""
        SELECT '2024-12-31' AS report_month, round(net + fee, 0)::double AS total_revenue_gbp, round(net, 0)::double AS total_nii_gbp,
               round(fee, 0)::double AS total_fee_income_gbp, customers AS total_active_customers, accounts AS total_active_accounts,
               round(book, 0)::double AS total_book_gbp, {_rounded('net * 120000', 'book * 100', 3)}::double AS nim_pct,
               {_rounded('arrears * 100', 'accounts', 2)}::double AS arrears_rate_pct
        FROM (SELECT sum(interest_charged_gbp) - sum(interest_earned_gbp) AS net,
                     coalesce(sum(fees_charged_gbp) FILTER (customer_id IN (SELECT customer_id FROM fact_transactions
                              WHERE date_trunc('month', transaction_date) = DATE '2024-12-01')), 0) AS fee,
                     count(DISTINCT customer_id) FILTER (account_status = 'Active') AS customers,
                     count(DISTINCT account_id) FILTER (account_status = 'Active') AS accounts,
                     sum(abs(balance_gbp)) FILTER (account_status = 'Active') AS book,
                     count(*) FILTER (account_status = 'Active' AND days_in_arrears > 0) AS arrears
              FROM account_rows WHERE snapshot_month = DATE '2024-12-01')""",
    # ---- staging and storage
    "customers_upsert": """
        SELECT customer_id, region, customer_segment,
               CASE WHEN o_orderkey IS NOT NULL THEN 'RM_' || lpad((o_orderkey % 500)::varchar, 4, '0') END AS relationship_mgr,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS updated_at
        FROM dim_customers LEFT JOIN
             (SELECT * FROM orders QUALIFY row_number() OVER
                 (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey % 500 DESC) = 1)
             ON customer_id = 'CUST' || lpad(o_custkey::varchar, greatest(8, length(o_custkey::varchar))::int, '0')""",
    "mcc_category": """
        SELECT spending_category AS transaction_category, count(*) AS transactions, sum(amount_gbp)::double AS amount_gbp
        FROM fact_transactions JOIN ref_merchant_categories ON mcc_code = merchant_category_code GROUP BY ALL""",
    "approx_distinct_accounts": """
        SELECT channel, count(DISTINCT account_id) AS exact_accounts, floor(count(DISTINCT account_id) * 0.03)::bigint AS bound,
               true AS within_bound
        FROM fact_transactions GROUP BY channel""",
    "approx_distinct_merchants": """
        SELECT channel, count(DISTINCT merchant_name) AS exact_merchants, true AS within_error
        FROM fact_transactions GROUP BY channel""",
    "staging_validate": """
        SELECT 'not_null:' || c AS rule, 0::bigint AS violations
        FROM (SELECT unnest(['transaction_id', 'customer_id', 'account_id', 'transaction_date', 'transaction_timestamp',
                             'amount_gbp']) AS c)
        UNION ALL SELECT 'enum:transaction_type', count(*) FILTER (transaction_type NOT IN ('Debit', 'Credit', 'Transfer', 'ATM'))
        FROM fact_transactions
        UNION ALL SELECT 'enum:channel', count(*) FILTER (channel NOT IN ('Mobile', 'Online', 'Branch', 'ATM', 'POS'))
        FROM fact_transactions
        UNION ALL SELECT 'check:amount_positive', count(*) FILTER (amount_gbp <= 0) FROM fact_transactions
        UNION ALL SELECT 'unique:transaction_id', count(*) - count(DISTINCT (l_orderkey, l_linenumber))
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "staging_reload": """
        SELECT load::bigint AS load, snapshot_month::varchar AS what, count(*) AS rows
        FROM fact_accounts CROSS JOIN (VALUES (1), (2)) v(load) GROUP BY ALL
        UNION ALL SELECT 1, 'rejected unique:account_id,snapshot_month', count(*) FROM fact_accounts WHERE snapshot_month = DATE '2024-11-01'
        UNION ALL SELECT 2, 'rejected unique:account_id,snapshot_month', count(*) + count(*) FILTER (snapshot_month = DATE '2024-11-01')
        FROM fact_accounts""",
    "staging_to_core": """
        SELECT outcome, what, count(*) AS rows
        FROM (SELECT CASE WHEN len(broken) = 0 THEN 'stored' ELSE 'rejected' END AS outcome,
                     unnest(CASE WHEN len(broken) = 0 THEN [snapshot_month::varchar] ELSE broken END) AS what
              FROM (SELECT snapshot_month,
                           CASE WHEN missed_payments_3m = 2 AND days_in_arrears = 0 THEN ['malformed']
                                ELSE list_concat(list_concat(
                                       CASE WHEN missed_payments_3m = 1 AND days_in_arrears > 60 THEN ['not_null:customer_id'] ELSE [] END,
                                       CASE WHEN missed_payments_3m = 3 THEN ['digits:balance_gbp'] ELSE [] END),
                                       CASE WHEN days_in_arrears > 80 THEN ['enum:account_status'] ELSE [] END) END AS broken
                    FROM fact_accounts))
        GROUP BY ALL""",
    "storage_accounts": """
        SELECT snapshot_month::varchar AS snapshot_month, count(*) AS accounts, sum(balance_gbp)::double AS balance_gbp
        FROM fact_accounts WHERE snapshot_month >= DATE '2024-10-01' GROUP BY ALL""",
    "retention_transactions": """
        SELECT transaction_date::varchar AS transaction_date, count(*) AS transactions
        FROM fact_transactions WHERE transaction_date >= DATE '2029-06-30' - 1825 GROUP BY ALL""",
}


def oracle_sql(star_given: bool = False) -> dict[str, str]:
    """With ``star_given`` the star tables are expected to exist and are not derived."""
    return {name: _sql(body, star_given) for name, body in QUERIES.items()}
