from signalmart.functions.columns import (  # noqa: F401
    blank_to_null, clean_code, epoch_to_utc, exact_sum, flag, format_ts,
    trunc_hour, typed, utc_to_local, weekend_flag,
)
