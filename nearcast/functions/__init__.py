from nearcast.functions.buckets import (  # noqa: F401
    combo_label, hour_label, lag_bucket, model_precip_bucket, model_wind_bucket,
    order_key, precip_bucket, route_label, sanity_label, timing_label,
    visibility_bucket, wind_bucket,
)
from nearcast.functions.cleaning import (  # noqa: F401
    cancel_aware_flag, clean_flag, clean_numeric, clean_numeric_trace, clean_text,
    null_if_cancelled, numeric_violations,
)
from nearcast.functions.keys import surrogate_key  # noqa: F401
from nearcast.functions.timeutil import (  # noqa: F401
    add_hours, calendar_features, departure_anchor, epoch_seconds, hhmm_string,
    hhmm_to_local, hhmm_to_utc, lag_minutes, local_to_utc, month_bounds, month_range,
    utc_to_local, year_month,
)
