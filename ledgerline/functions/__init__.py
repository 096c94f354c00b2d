from ledgerline.functions.columns import (
    deviation_of_sums,
    distinct_months,
    first_match,
    hash_bucket,
    mean_of,
    month_of,
    round_ratio,
    safe_ratio,
    square_sums,
    years_apart,
)

__all__ = [
    "deviation_of_sums", "distinct_months", "first_match", "hash_bucket", "mean_of", "month_of", "round_ratio",
    "safe_ratio", "square_sums", "years_apart",
]
