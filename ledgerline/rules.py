"""Fixed values. Results depend on every one of them, so they are stated once, here."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

# --- customer value segments: label, then inclusive score ranges for recency, frequency
# and monetary. The first match wins. "Cannot Lose Them" is kept although "Loyal
# Customers" always matches first.
RFM_SEGMENTS = [
    ("Champions",           (5, 5), (4, 5), (4, 5)),
    ("Loyal Customers",     (1, 5), (4, 5), (3, 5)),
    ("Potential Loyalists", (4, 5), (2, 3), (1, 5)),
    ("New Customers",       (5, 5), (1, 1), (1, 5)),
    ("Promising",           (4, 4), (1, 1), (1, 5)),
    ("Need Attention",      (3, 3), (3, 5), (3, 5)),
    ("About To Sleep",      (2, 3), (1, 2), (1, 5)),
    ("At Risk",             (1, 2), (3, 5), (3, 5)),
    ("Cannot Lose Them",    (1, 1), (4, 5), (4, 5)),
    ("Hibernating",         (1, 2), (1, 2), (1, 5)),
]
RFM_OTHER = "Others"
RFM_QUANTILES = 5
RFM_WINDOW_MONTHS = 12
CLV_TIERS = [(4.0, "High Value"), (2.5, "Mid Value")]
CLV_OTHER = "Low Value"

# --- structuring: amounts just below the reporting threshold (both ends inclusive)
STRUCTURING_LOW, STRUCTURING_HIGH = Decimal("7500"), Decimal("9999")
STRUCTURING_FRAME = 7
STRUCTURING_MIN_COUNT, STRUCTURING_MIN_TOTAL = 2, Decimal("10000")
STRUCTURING_SEVERITY = [  # count at least, total above
    (5, Decimal("40000"), "Critical"),
    (3, Decimal("25000"), "High"),
    (2, Decimal("15000"), "Medium"),
]
STRUCTURING_ALERT = "Structuring - Sub-threshold credits"

# --- velocity: one day against the customer's own history
VELOCITY_HISTORY_DAYS, VELOCITY_RECENT_DAYS = 90, 7
VELOCITY_MULTIPLE = 3
VELOCITY_SEVERITY = [(10, "Critical"), (5, "High"), (3, "Medium")]  # ratio above
VELOCITY_ALERT = "Velocity - Unusual daily spend spike"

# --- repeated round amounts
LAYERING_DAYS = 3
LAYERING_MIN_CREDITS, LAYERING_MIN_SHARE_PCT = Decimal("5000"), 80
LAYERING_ALERT = "Layering - Credits passed on"

ROUND_DAYS, ROUND_STEP, ROUND_MIN_COUNT = 30, 100, 5
ROUND_LOW, ROUND_HIGH = Decimal("500"), Decimal("10000")  # low inclusive, high exclusive
ROUND_SEVERITY = [  # count at least, total above
    (10, Decimal("50000"), "High"),
    (5, Decimal("20000"), "Medium"),
]
ROUND_ALERT = "Round-amount repetition"

# --- geographic anomaly: a country against the one before
GEO_HISTORY_DAYS, GEO_RECENT_DAYS = 365, 30
GEO_GAPS, GEO_GAP_OTHER = [(0, "same day"), (3, "1-3 days"), (14, "4-14 days")], "15+ days"  # days at most
GEO_COUNTRIES = 249  # codes of ISO 3166-1
GEO_PRIOR, GEO_MAX_PROBABILITY = 10, 0.1
GEO_NO_SEGMENT = "Unknown"
GEO_ALERT = "Geographic anomaly"

SEVERITY_OTHER = "Low"

# --- churn
CHURN_HORIZON_DAYS, CHURN_MONTHS, CHURN_TREND_MONTHS = 90, 6, 3
CHURN_NO_TRANSACTION_DAYS = 999
CHURN_TIERS = [  # probability at least
    (0.75, "Imminent (75%+)"),
    (0.50, "High Risk (50-75%)"),
    (0.25, "At Risk (25-50%)"),
]
CHURN_TIER_OTHER = "Low Risk (<25%)"
CHURN_CATEGORICAL = ["customer_segment", "region"]
CHURN_NUMERIC = [
    "age", "tenure_years", "txn_count_6m", "total_spend_6m", "avg_txn_amount_6m",
    "unique_categories", "active_months_6m", "days_since_last_txn", "mobile_txns",
    "spend_trend_pct", "product_count", "avg_credit_utilisation", "max_days_in_arrears",
    "total_missed_payments_3m", "overdrawn_accounts", "dormant_accounts", "nps_score",
]
CHURN_EVAL_FRACTION, CHURN_MAX_ITER, CHURN_L1, CHURN_L2 = 0.2, 50, 0.1, 0.1

# --- cross-sell
CROSS_SELL_MONTHS = 6
INTERNATIONAL_CATEGORIES = ["International", "FX"]
RENT_CATEGORY = "Mortgage/Rent"
HOME_COUNTRY = "GB"
SAVINGS_MIN_BALANCE, CARD_MIN_SPEND = 2000, 1500
MORTGAGE_MIN_RENT, MORTGAGE_MIN_BALANCE, TRAVEL_MIN_INTERNATIONAL = 4, 10000, 10
NEXT_BEST_PRODUCT = [  # first raised flag wins
    ("opportunity_mortgage", "Residential Mortgage"),
    ("opportunity_credit_card", "Cashback Credit Card"),
    ("opportunity_savings", "Fixed Rate Bond 12M"),
    ("opportunity_travel_card", "Platinum Credit Card"),
]
NEXT_BEST_OTHER = "None"

# --- customer build
GEN_SEGMENTS = [(70, "Retail"), (92, "Premier")]  # bucket below
GEN_SEGMENT_OTHER = "Private"
GEN_STUDENT_BELOW = 15
GEN_RISKS = [(75, "Low"), (93, "Medium")]  # bucket below
GEN_RISK_OTHER = "High"
GEN_AGE_BANDS = [  # whole years, inclusive
    (18, 24, "18-24"), (25, 34, "25-34"), (35, 44, "35-44"), (45, 54, "45-54"), (55, 64, "55-64"),
]
GEN_AGE_OTHER = "65+"
GEN_REGIONS = [
    ("London", "SW1"), ("London", "EC1"), ("South East", "RG1"), ("North West", "M1"),
    ("Yorkshire", "LS1"), ("Scotland", "EH1"), ("Midlands", "B1"), ("South West", "BS1"),
]

# --- calendar
CALENDAR_START, CALENDAR_END = date(2022, 1, 1), date(2024, 12, 31)
UK_BANK_HOLIDAYS = [
    date(2022, 1, 3), date(2022, 4, 15), date(2022, 4, 18), date(2022, 5, 2), date(2022, 6, 2),
    date(2022, 6, 3), date(2022, 8, 29), date(2022, 9, 19), date(2022, 12, 26), date(2022, 12, 27),
    date(2023, 1, 2), date(2023, 4, 7), date(2023, 4, 10), date(2023, 5, 1), date(2023, 5, 8),
    date(2023, 5, 29), date(2023, 8, 28), date(2023, 12, 25), date(2023, 12, 26),
    date(2024, 1, 1), date(2024, 3, 29), date(2024, 4, 1), date(2024, 5, 6), date(2024, 5, 27),
    date(2024, 8, 26), date(2024, 12, 25), date(2024, 12, 26),
]

# --- product catalogue: id, code, name, type, family, rate, monthly fee, limit, launch
PRODUCT_CATALOGUE = [
    ("PRD001", "CA_ADVANCE", "Advance Current Account", "Current Account", "Deposits", "0.00", "0.00", None, "2015-01-01"),
    ("PRD002", "CA_SELECT", "Select Current Account", "Current Account", "Deposits", "0.00", "12.95", None, "2018-06-01"),
    ("PRD003", "SA_FLEX", "Flexible Saver", "Savings", "Deposits", "3.50", "0.00", None, "2020-01-01"),
    ("PRD004", "SA_FIXED12", "Fixed Rate Bond 12M", "Savings", "Deposits", "5.10", "0.00", None, "2023-01-01"),
    ("PRD005", "SA_ISA", "Cash ISA", "Savings", "Deposits", "3.80", "0.00", None, "2016-04-06"),
    ("PRD006", "CC_PLATINUM", "Platinum Credit Card", "Credit Card", "Lending", "22.90", "0.00", "15000.00", "2019-03-01"),
    ("PRD007", "CC_CASHBACK", "Cashback Credit Card", "Credit Card", "Lending", "19.90", "0.00", "10000.00", "2021-01-01"),
    ("PRD008", "LN_PERSONAL", "Personal Loan", "Loan", "Lending", "8.90", "0.00", None, "2017-01-01"),
    ("PRD009", "LN_VEHICLE", "Vehicle Finance Loan", "Loan", "Lending", "6.50", "0.00", None, "2020-06-01"),
    ("PRD010", "MG_RESIDENTIAL", "Residential Mortgage", "Mortgage", "Lending", "4.25", "0.00", None, "2010-01-01"),
    ("PRD011", "MG_BTL", "Buy-to-Let Mortgage", "Mortgage", "Lending", "5.10", "0.00", None, "2012-01-01"),
]
