from .scalar import (DAYS_SENTINEL, DELAY_IMPORTANCE, TIME_CONSTANT, clip0, days_since,
                     delay_seriousness, differs_or_missing, flag_not_equal, flag_not_negative,
                     hash01, hash_hex8, months_before, neq_keep_null, nullif_sentinel,
                     safe_div, sentinel_to_zero, status_int)
from .rowwise import (ROW_STATS, row_count, row_mean, row_product, row_sum, row_total,
                      with_row_stats)

__all__ = [
    "DAYS_SENTINEL", "DELAY_IMPORTANCE", "TIME_CONSTANT", "clip0", "days_since",
    "delay_seriousness", "differs_or_missing", "flag_not_equal", "flag_not_negative",
    "hash01", "hash_hex8", "months_before", "neq_keep_null", "nullif_sentinel", "safe_div",
    "sentinel_to_zero", "status_int", "ROW_STATS", "row_count", "row_mean",
    "row_product", "row_sum", "row_total", "with_row_stats",
]
