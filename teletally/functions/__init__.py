"""Column expressions: dates, categories, labels and metric formulas."""

from teletally.functions.categories import (
    category_by_case,
    category_by_list,
    check_codes,
    export_label,
    has_category,
    with_category_by_dimension,
)
from teletally.functions.dates import compact_date, days_between, file_date
from teletally.functions.scores import (
    active_any,
    active_rate,
    active_sum,
    active_total,
    activity_level,
    engagement_type,
    presence_label,
    seen_categories,
    taste,
    top_category,
)

__all__ = [
    "active_any",
    "active_rate",
    "active_sum",
    "active_total",
    "activity_level",
    "category_by_case",
    "category_by_list",
    "check_codes",
    "compact_date",
    "days_between",
    "engagement_type",
    "export_label",
    "file_date",
    "has_category",
    "presence_label",
    "seen_categories",
    "taste",
    "top_category",
    "with_category_by_dimension",
]
