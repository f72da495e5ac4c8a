from tidewatch.plans.checks import (  # noqa: F401
    check_slides, check_state, check_window_advanced, check_window_contents, check_window_verdict,
)
from tidewatch.plans.pipeline import Pipeline, read_kpi_daily, write_kpi_daily, write_window_table  # noqa: F401
from tidewatch.plans.slides import (  # noqa: F401
    kpi_daily_slides, kpi_global_slides, kpi_sliding_eventtime, slides_window,
)
from tidewatch.plans.state import StateStore  # noqa: F401
from tidewatch.plans.windows import (  # noqa: F401
    advance_state, latest_state, slides_until, state_bounds, state_from_data, state_row,
    window_list,
)
