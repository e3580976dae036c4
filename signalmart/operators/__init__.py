"""DataFrame -> DataFrame building blocks (all built-in Spark expressions)."""

from signalmart.operators.alerts import alert_digest, alert_rows, latest_snapshot, top_recent  # noqa: F401
from signalmart.operators.baseline import pct_vs_baseline, trailing_baseline  # noqa: F401
from signalmart.operators.calendar import guard_calendar, join_calendar  # noqa: F401
from signalmart.operators.dedupe import key_copy_counts, latest_per_key  # noqa: F401
from signalmart.operators.rollups import daily_weather, rollup_counts  # noqa: F401
from signalmart.operators.rules import (  # noqa: F401
    Rule, demand_rules, driver_points, driver_text, drivers, interpret, label, score,
    with_flags)
