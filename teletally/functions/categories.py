"""App code to content category."""

from __future__ import annotations

from functools import reduce
from itertools import chain
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from teletally.schema import APP_CODES, ERROR, LOCAL_LABELS, CategoryCodes


def check_codes(codes: CategoryCodes) -> None:
    """Refuse a code listed under two categories, which would make the mapping ambiguous."""
    listed = list(chain.from_iterable(codes.values()))
    repeated = {code for code in listed if listed.count(code) > 1}
    if repeated:
        raise ValueError(f"app codes listed more than once: {sorted(repeated)}")


def _case(branches: list[tuple[Column, str]]) -> Column:
    """CASE over the branches in order, ``Error`` where none holds."""
    first, *rest = branches
    chained = reduce(lambda case, branch: case.when(*branch), rest, F.when(*first))
    return chained.otherwise(ERROR)


def category_by_case(app: Column, codes: CategoryCodes = APP_CODES) -> Column:
    """CASE over equality tests; NULL and unlisted codes become ``Error``."""
    check_codes(codes)
    branches = [
        (reduce(or_, [app == code for code in listed]), label) for label, listed in codes.items() if listed
    ]
    return _case(branches)


def category_by_list(app: Column, codes: CategoryCodes = APP_CODES) -> Column:
    """Same mapping with one membership test per category."""
    check_codes(codes)
    branches = [(app.isin(*listed), label) for label, listed in codes.items() if listed]
    return _case(branches)


def has_category(app: Column, codes: CategoryCodes = APP_CODES) -> Column:
    """Whether the app code is mapped: the same rows as ``category != 'Error'``.

    One membership test on the raw column, so it reaches the scan as a pushed filter.
    """
    return app.isin(*chain.from_iterable(codes.values()))


def with_category_by_dimension(log: DataFrame, codes: CategoryCodes = APP_CODES) -> DataFrame:
    """Same mapping as a join to the category dimension.

    The dimension has one row per listed code, so its size is set by ``codes`` and not by
    the log: the broadcast is bounded, and the log is not shuffled.
    """
    check_codes(codes)
    rows = [(code, label) for label, listed in codes.items() for code in listed]
    dimension = log.sparkSession.createDataFrame(rows, "app_name string, category string")
    joined = log.join(F.broadcast(dimension), "app_name", "left")
    return joined.withColumn("category", F.coalesce("category", F.lit(ERROR)))


def export_label(category: Column) -> Column:
    """Category in the language of the log's owner."""
    pairs = chain.from_iterable(LOCAL_LABELS.items())
    return F.create_map(*[F.lit(text) for text in pairs])[category]
