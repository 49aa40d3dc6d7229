"""Column-level functions (native Spark expressions only)."""

from .calendar import (cyclic, day_of_week, hour, is_friday_evening, is_monday_morning,
                       is_peak_hour, month)
from .domain import (band_verdict, capacity_group, code_label, is_frozen, is_stormy,
                     profile_class, right_closed_bin, severity_label, weather_severity,
                     weekday_label)
from .flags import decode_tf, project_features, rename_legacy, resolve_alias, truthy, truthy_flag
from .numeric import (abs_error, clip, exact_mean, exact_sum, round6, round_half_even,
                      safe_ratio)

__all__ = [
    "abs_error", "band_verdict", "capacity_group", "clip", "code_label", "cyclic",
    "day_of_week", "decode_tf", "exact_mean", "exact_sum", "hour", "is_friday_evening",
    "is_frozen", "is_monday_morning", "is_peak_hour", "is_stormy", "month",
    "profile_class", "project_features", "rename_legacy", "resolve_alias",
    "right_closed_bin", "round6", "round_half_even", "safe_ratio", "severity_label",
    "truthy", "truthy_flag", "weather_severity", "weekday_label",
]
