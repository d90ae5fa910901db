"""Column builders: each takes columns and returns a column."""
from pavilion.functions.classify import band, contains_label, high_impact, map_codes
from pavilion.functions.dates import DEFAULT_DATE_FORMATS, date_parts, parse_date, year_after_days_back
from pavilion.functions.numbers import is_true, whole_number, whole_or_zero
from pavilion.functions.text import fill_blank, is_blank, normalise_name, standardise

__all__ = [
    "DEFAULT_DATE_FORMATS", "band", "contains_label", "date_parts", "fill_blank", "high_impact",
    "is_blank", "is_true", "map_codes", "normalise_name", "parse_date", "standardise",
    "whole_number", "whole_or_zero", "year_after_days_back",
]
