from tidewatch.operators.addresses import (  # noqa: F401
    active_addresses_daily, active_addresses_global, address_edges, daily_address_set,
    explode_addresses, window_address_set,
)
from tidewatch.operators.extract import (  # noqa: F401
    extract_window, filter_month, filter_month_range, filter_ts_halfopen, project_window,
)
from tidewatch.operators.kpi import (  # noqa: F401
    avg_value_daily, coinbase_share_daily, complexity_daily, day_partials, kpi_daily, kpi_global,
    median_value_daily, tx_count_daily, velocity_daily, volume_daily, whale_ratio_daily,
    whale_transactions, whale_volume_global,
)
