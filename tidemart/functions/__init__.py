"""Column functions: Column in, Column out."""

from tidemart.functions.calendar import (
    calendar_columns,
    date_add,
    date_diff,
    date_id,
    date_id_text,
    hours_between_dates,
)
from tidemart.functions.geo import degrees_to_radians, haversine_distance
from tidemart.functions.keys import surrogate_key
from tidemart.functions.scalar import (
    column,
    installment_level,
    installment_value,
    is_present,
    not_blank,
    null_text_to_null,
    safe_add,
    safe_divide,
    safe_subtract,
    width_bucket,
)
from tidemart.functions.similarity import jaro_winkler
from tidemart.functions.text import slugify, slugify_name
from tidemart.functions.urls import url_host, url_parameter, url_path

__all__ = [
    "calendar_columns",
    "column",
    "date_add",
    "date_diff",
    "date_id",
    "date_id_text",
    "degrees_to_radians",
    "haversine_distance",
    "hours_between_dates",
    "installment_level",
    "installment_value",
    "is_present",
    "jaro_winkler",
    "not_blank",
    "null_text_to_null",
    "safe_add",
    "safe_divide",
    "safe_subtract",
    "slugify",
    "slugify_name",
    "surrogate_key",
    "url_host",
    "url_parameter",
    "url_path",
    "width_bucket",
]
