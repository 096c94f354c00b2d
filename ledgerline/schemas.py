"""The star schema: one :class:`Table` per declared table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
#: rates and percentages keep nine decimals
RATE = T.DecimalType(38, 9)
WIDE = T.DecimalType(38, 18)
#: holds a landed row that can't be read in the declared types
MALFORMED = "malformed_row"
_STR, _INT, _BOOL, _DATE, _TS = (
    T.StringType(), T.LongType(), T.BooleanType(), T.DateType(), T.TimestampType(),
)


@dataclass(frozen=True)
class Table:
    """A declared table: schema plus what storage and validation need to know."""

    name: str
    comment: str
    schema: T.StructType
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    enums: dict[str, tuple[str, ...]] = field(default_factory=dict)
    checks: dict[str, Column | str] = field(default_factory=dict)
    retention_days: int | None = None

    def conform(self, df: DataFrame) -> DataFrame:
        """Cast to the declared types, in declared order.

        A column the input does not carry takes its declared default (NULL when it
        has none); an explicit NULL in the input stays NULL.
        """
        present = set(df.columns)
        return df.select(*[
            (F.col(f.name) if f.name in present else F.lit(self.defaults.get(f.name)))
            .cast(f.dataType).alias(f.name)
            for f in self.schema
        ])

    def landed_schema(self) -> T.StructType:
        """What landed files are read as: decimals wide enough to see every digit, and a place for unreadable rows."""
        return T.StructType([
            *[T.StructField(f.name, WIDE if isinstance(f.dataType, T.DecimalType) else f.dataType) for f in self.schema],
            T.StructField(MALFORMED, T.StringType()),
        ])

    def ddl(self, database: str | None = None) -> str:
        """``CREATE TABLE IF NOT EXISTS`` with NOT NULL, DEFAULT, layout and comment."""
        cols = []
        for f in self.schema:
            text = f"{f.name} {f.dataType.simpleString().upper()}"
            if not f.nullable:
                text += " NOT NULL"
            if f.name in self.defaults:
                value = self.defaults[f.name]
                text += f" DEFAULT {value!r}" if isinstance(value, str) else f" DEFAULT {value}".upper()
            cols.append(text)
        qualified = f"{database}.{self.name}" if database else self.name
        sql = f"CREATE TABLE IF NOT EXISTS {qualified} ({', '.join(cols)}) USING parquet"
        if self.partition_by:
            sql += f" PARTITIONED BY ({', '.join(self.partition_by)})"
        sql += f" COMMENT '{self.comment}'"
        # the order of rows within files, which writers keep; the catalog has no clause for it
        return sql + (f" TBLPROPERTIES ('clustered.by' = '{','.join(self.cluster_by)}')" if self.cluster_by else "")


def _schema(*cols: tuple) -> T.StructType:
    """``(name, type)`` or ``(name, type, "required")``."""
    return T.StructType([T.StructField(c[0], c[1], nullable=len(c) < 3) for c in cols])


_REQ = "required"

CUSTOMERS = Table(
    name="dim_customers",
    comment="One row per customer",
    key=("customer_id",),
    schema=_schema(
        ("customer_id", _STR, _REQ), ("first_name", _STR), ("last_name", _STR),
        ("date_of_birth", _DATE), ("age_band", _STR), ("gender", _STR),
        ("postcode_district", _STR), ("region", _STR), ("country", _STR),
        ("customer_since", _DATE), ("customer_segment", _STR), ("is_student", _BOOL),
        ("is_business", _BOOL), ("kyc_status", _STR), ("risk_rating", _STR),
        ("relationship_mgr", _STR), ("nps_score", _INT), ("created_at", _TS),
        ("updated_at", _TS),
    ),
    defaults={"country": "GB", "is_student": False, "is_business": False},
    enums={
        "age_band": ("18-24", "25-34", "35-44", "45-54", "55-64", "65+"),
        "customer_segment": ("Retail", "Premier", "Private"),
        "kyc_status": ("Verified", "Pending", "Failed"),
        "risk_rating": ("Low", "Medium", "High"),
    },
    checks={
        "customer_id_format": "customer_id rlike '^CUST[0-9]{8,}$'",
        "nps_range": "nps_score between -100 and 100",
    },
)

PRODUCTS = Table(
    name="dim_products",
    comment="Product catalogue, one row per product",
    key=("product_id",),
    schema=_schema(
        ("product_id", _STR, _REQ), ("product_code", _STR), ("product_name", _STR),
        ("product_type", _STR), ("product_family", _STR), ("interest_rate", RATE),
        ("fee_monthly", MONEY), ("credit_limit_max", MONEY), ("is_active", _BOOL),
        ("launch_date", _DATE), ("retired_date", _DATE),
    ),
    defaults={"is_active": True},
    enums={
        "product_type": ("Current Account", "Savings", "Credit Card", "Mortgage", "Loan"),
        "product_family": ("Deposits", "Lending", "Payments"),
    },
    checks={"product_id_format": "product_id rlike '^PRD[0-9]{3,}$'"},
)

TRANSACTIONS = Table(
    name="fact_transactions",
    comment="One row per transaction, by day, ordered by customer and type",
    key=("transaction_id",),
    partition_by=("transaction_date",),
    cluster_by=("customer_id", "transaction_type"),
    retention_days=1825,
    schema=_schema(
        ("transaction_id", _STR, _REQ), ("customer_id", _STR, _REQ),
        ("account_id", _STR, _REQ), ("product_id", _STR),
        ("transaction_date", _DATE, _REQ), ("transaction_timestamp", _TS, _REQ),
        ("transaction_type", _STR), ("transaction_category", _STR),
        ("merchant_name", _STR), ("merchant_category_code", _STR),
        ("merchant_country", _STR), ("amount_gbp", MONEY, _REQ),
        ("running_balance_gbp", MONEY), ("channel", _STR), ("is_international", _BOOL),
        ("is_recurring", _BOOL), ("is_flagged", _BOOL), ("flag_reason", _STR),
        ("batch_load_timestamp", _TS),
    ),
    defaults={
        "merchant_country": "GB", "is_international": False,
        "is_recurring": False, "is_flagged": False,
    },
    enums={
        "transaction_type": ("Debit", "Credit", "Transfer", "ATM"),
        "channel": ("Mobile", "Online", "Branch", "ATM", "POS"),
    },
    checks={"amount_positive": "amount_gbp > 0"},
)

ACCOUNTS = Table(
    name="fact_accounts",
    comment="Month-end state of each account, one row per account and month",
    key=("account_id", "snapshot_month"),
    partition_by=("snapshot_month",),
    cluster_by=("customer_id", "product_id"),
    schema=_schema(
        ("account_id", _STR, _REQ), ("customer_id", _STR, _REQ),
        ("product_id", _STR, _REQ), ("snapshot_month", _DATE, _REQ),
        ("account_status", _STR), ("balance_gbp", MONEY), ("credit_limit_gbp", MONEY),
        ("utilisation_pct", RATE), ("days_in_arrears", _INT),
        ("missed_payments_3m", _INT), ("interest_charged_gbp", MONEY),
        ("fees_charged_gbp", MONEY), ("interest_earned_gbp", MONEY),
        ("opened_date", _DATE), ("closed_date", _DATE),
    ),
    defaults={"days_in_arrears": 0, "missed_payments_3m": 0},
    enums={"account_status": ("Active", "Dormant", "Closed", "Overdrawn")},
    checks={"month_is_first_day": "snapshot_month = trunc(snapshot_month, 'MM')"},
)

DATES = Table(
    name="dim_date",
    comment="Calendar, one row per day",
    key=("date_id",),
    schema=_schema(
        ("date_id", _DATE, _REQ), ("year", _INT), ("quarter", _INT), ("month", _INT),
        ("month_name", _STR), ("week_of_year", _INT), ("day_of_week", _INT),
        ("day_name", _STR), ("is_weekend", _BOOL), ("is_uk_bank_holiday", _BOOL),
        ("fiscal_year", _INT), ("fiscal_quarter", _STR),
    ),
)

MERCHANT_CATEGORIES = Table(
    name="ref_merchant_categories",
    comment="Merchant category codes",
    key=("mcc_code",),
    schema=_schema(
        ("mcc_code", _STR, _REQ), ("mcc_description", _STR),
        ("spending_category", _STR), ("is_high_risk", _BOOL),
    ),
    defaults={"is_high_risk": False},
)

EXECUTIVE_SUMMARY = Table(
    name="monthly_executive_summary",
    comment="Headline figures, one row per month",
    key=("report_month",),
    partition_by=("report_month",),
    schema=_schema(
        ("report_month", _DATE, _REQ), ("total_revenue_gbp", T.DecimalType(38, 2)),
        ("total_nii_gbp", T.DecimalType(38, 2)), ("total_fee_income_gbp", T.DecimalType(38, 2)),
        ("total_active_customers", _INT), ("total_active_accounts", _INT),
        ("total_book_gbp", T.DecimalType(38, 2)), ("avg_nim_pct", T.DoubleType()),
        ("avg_arrears_rate_pct", T.DoubleType()), ("inserted_at", _TS),
    ),
)

ACTIVITY = Table(
    name="customer_activity",
    comment="Unflagged transactions summed by customer, day and merchant; what the segmentation needs of them",
    key=("customer_id", "transaction_date", "merchant_name"),
    partition_by=("transaction_date",),
    cluster_by=("customer_id",),
    schema=_schema(
        ("customer_id", _STR, _REQ), ("transaction_date", _DATE, _REQ), ("merchant_name", _STR),
        ("spend", T.DecimalType(28, 2)), ("n", _INT),
    ),
)

STAR = {t.name: t for t in (
    CUSTOMERS, PRODUCTS, TRANSACTIONS, ACCOUNTS, DATES, MERCHANT_CATEGORIES,
)}
