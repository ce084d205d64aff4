"""Number expressions that hold with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ieee_divide(x: Column, y: Column) -> Column:
    """Double division where 0/0 is NaN and x/0 is infinite, never an error."""
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    return (
        F.when(x.isNull() | y.isNull(), F.lit(None).cast("double"))
        # NaN > 0 is true in Spark, so a NaN numerator must leave first.
        .when(F.isnan(x), nan)
        .when(y != 0, F.try_divide(x, y))
        .when(x > 0, inf)
        .when(x < 0, -inf)
        .otherwise(nan)
    )


def parse_double(text: Column) -> Column:
    """Text as a double; missing or malformed text stops the job."""
    return F.coalesce(
        text.try_cast("double"),
        F.raise_error(F.concat(F.lit("not a number: "), F.coalesce(text, F.lit("(missing)")))).cast("double"),
    )


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)
