from tidewatch.functions.columns import (  # noqa: F401
    as_date, day_of, distinct_addresses, month_of, safe_ratio, sat_of_coin,
    sat_to_coin, slide_range, ts_lower, ts_upper, window_predicate,
)
