"""Column expressions (JVM-side, whole-stage codegen friendly)."""

from stationqc.functions.columns import (  # noqa: F401
    col_, season, hour_floor, epoch_seconds, epoch_to_ntz, days_in_month, mask, nan_to_null,
    utm_xy, month_key, valid_from_year, timeframe_label, round4, round_to,
)
