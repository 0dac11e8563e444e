from stationloom.functions.scalars import (
    city_label,
    city_slug,
    date_part_text,
    format_offset,
    iso_format,
    month_abbr,
    month_label,
    month_name,
    nan_to_null,
    null_tokens_to_null,
    number_column,
    observation_instant,
    offset_hours,
    offset_hours_strict,
    offset_minutes,
    percentage,
    round_n,
    source_of,
    to_number,
    to_utc_timestamp,
    unit_of,
    year_month,
)

__all__ = [
    "city_label", "city_slug", "date_part_text", "format_offset", "iso_format",
    "month_abbr", "month_label", "month_name", "nan_to_null",
    "null_tokens_to_null", "number_column", "observation_instant",
    "offset_hours", "offset_hours_strict", "offset_minutes", "percentage",
    "round_n", "source_of", "to_number", "to_utc_timestamp", "unit_of",
    "year_month",
]
