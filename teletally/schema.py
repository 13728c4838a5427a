"""Column names, declared schemas and the fixed category dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import types as T

CategoryCodes = Mapping[str, Sequence[str]]

# Category order (decides ties and the order inside a taste).
CATEGORIES = ("Relax", "Movie", "Child", "Sport", "TV")
ERROR = "Error"

# App codes of the viewing log, matched exactly and case-sensitively.
APP_CODES: CategoryCodes = {
    "TV": ("CHANNEL", "DSHD", "KPLUS", "KPlus"),
    "Movie": ("VOD", "FIMS_RES", "BHD_RES", "VOD_RES", "FIMS", "BHD", "DANET"),
    "Relax": ("RELAX",),
    "Child": ("CHILD",),
    "Sport": ("SPORT",),
}

# Category labels in the language of the log's owner.
LOCAL_LABELS = {
    "Relax": "Giải Trí",
    "Movie": "Phim Truyện",
    "Child": "Thiếu Nhi",
    "Sport": "Thể Thao",
    "TV": "Truyền Hình",
    "Error": "Error",
}

# Column names of exported tables.
EXPORT_NAMES = {
    "contract": "Contract",
    "app_name": "AppName",
    "category": "Type",
    "log_date": "Date",
    "duration": "TotalDuration",
    "total": "TotalDuration",
    "relax_duration": "RelaxDuration",
    "movie_duration": "MovieDuration",
    "child_duration": "ChildDuration",
    "sport_duration": "SportDuration",
    "tv_duration": "TVDuration",
    "most_watch": "MostWatch",
    "customer_taste": "CustomerTaste",
    "active_days": "ActiveDays",
    "active_rate": "ActiveRate",
    "engagement_type": "EngagementType",
    "customer_group": "Group",
}

UNKNOWN_CONTRACT = "0"


def duration_column(category: str) -> str:
    """Pivot column holding the viewing time of one category."""
    return f"{category.lower()}_duration"


DURATION_COLUMNS = tuple(duration_column(c) for c in CATEGORIES)


def raw_log_schema() -> T.StructType:
    """Schema of one raw JSON line; only the three payload fields in use are parsed.

    The duration is read as text: a declared number would turn what does not fit into NULL.
    """
    payload = T.StructType(
        [
            T.StructField("Contract", T.StringType()),
            T.StructField("AppName", T.StringType()),
            T.StructField("TotalDuration", T.StringType()),
        ]
    )
    return T.StructType([T.StructField("_source", payload)])


def log_schema(duration: T.DataType | None = None) -> T.StructType:
    """Schema of a flattened log row."""
    return T.StructType(
        [
            T.StructField("contract", T.StringType()),
            T.StructField("app_name", T.StringType()),
            T.StructField("duration", duration or T.LongType()),
            T.StructField("log_date", T.DateType()),
        ]
    )


def profile_schema(duration: T.DataType | None = None) -> T.StructType:
    """Schema of the customer profile (contract grain)."""
    return T.StructType(
        [T.StructField("contract", T.StringType())]
        + [T.StructField(c, duration or T.LongType()) for c in DURATION_COLUMNS]
        + [
            T.StructField("most_watch", T.StringType()),
            T.StructField("customer_taste", T.StringType()),
            T.StructField("active_days", T.LongType()),
            T.StructField("active_rate", T.DoubleType()),
        ]
    )
