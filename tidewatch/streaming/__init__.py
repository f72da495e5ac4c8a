from tidewatch.streaming.address_pairs import sliding_address_stream  # noqa: F401
from tidewatch.streaming.address_runs import slide_counts, sliding_address_runs  # noqa: F401
from tidewatch.streaming.exact_median import daily_value_counts_stream, read_median_daily  # noqa: F401
from tidewatch.streaming.kpi_stream import (  # noqa: F401
    EVENT_DAILY_KEYS, active_addresses_stream, compact_live, count_addresses, daily_address_stream,
    daily_kpis_stream, live_rows, read_file_stream, read_live, rows_without_event_time, run_available_now,
    sliding_active_addresses_stream, sliding_kpis_stream, write_live,
)
from tidewatch.streaming.repair import Intake, Repairs, daily_repairs  # noqa: F401
from tidewatch.streaming.sources import (  # noqa: F401
    EVENT_TX_SCHEMA, events_as_tx, tx_as_stream_rows,
)
