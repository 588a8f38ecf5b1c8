"""Column validation report of one sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldlab.operators.validate import conversion_profile, failed_values, values_by_day


def column_report(
    df: DataFrame, columns: list[str], day: str, order: list[str] = (), first: int | None = None
) -> dict[str, DataFrame]:
    """Conversion profile, values that failed, and counts per day and value for each column."""
    return {
        "profile": conversion_profile(df, columns),
        "failed": failed_values(df, [day], columns, order, first),
        "by_day": values_by_day(df, day, columns),
    }
