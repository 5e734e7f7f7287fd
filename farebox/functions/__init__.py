from farebox.functions.labels import (
    above,
    between_bands,
    business_model,
    fare_tier,
    hour_range,
    month_name,
    period_order,
    period_pt,
    service_area,
    time_period,
    tip_category,
    value_segment,
)
from farebox.functions.numbers import hundredths, mean, minutes_between, percent, rounded, stddev, units
from farebox.functions.keys import file_record_key, trip_id

__all__ = [
    "above", "between_bands", "business_model", "fare_tier", "file_record_key", "hour_range",
    "hundredths", "mean", "minutes_between", "month_name", "percent", "period_order",
    "period_pt", "rounded", "service_area", "stddev", "time_period", "tip_category", "trip_id",
    "units", "value_segment",
]
