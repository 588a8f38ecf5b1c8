"""The two dashboard queries: one filtered table view, and the joined interview view."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlab.operators.filters import between_dates, facet_filter
from fieldlab.operators.joins import natural_join_all, stacked_groups
from fieldlab.operators.reshape import chosen_tables, to_wide
from fieldlab.operators.shape import in_front


def table_view(
    tables: Mapping[str, DataFrame], matrix: DataFrame, display_name: str, date: str = "date",
    first: str | None = None, last: str | None = None, chosen: Mapping[str, Iterable] | None = None,
    wide: Mapping | None = None,
) -> DataFrame:
    """Tables marked for a display name, naturally joined as text, then date and facet filters.

    ``wide`` holds ``to_wide`` arguments for views that show results as columns.
    """
    marked = {r["name"] for r in chosen_tables(matrix, display_name).collect()}
    shown = [df for name, df in tables.items() if name in marked]
    if dict(shown[0].dtypes).get(date, "string") != "string":
        # Rows of the first table survive every left join, so its typed dates can be cut in the scan.
        shown[0] = between_dates(shown[0], date, first, last)
    joined = natural_join_all(shown)
    if date in joined.columns:
        joined = in_front(joined.withColumn(date, F.to_date(F.col(date).try_cast("timestamp_ntz"))), date)
        joined = between_dates(joined, date, first, last)
    joined = facet_filter(joined, chosen or {})
    return to_wide(joined, **wide) if wide else joined


def answers_wide(
    questions: DataFrame, answers: DataFrame, on: list[str], order: str, names: list[str] | None = None
) -> DataFrame:
    """Question texts as columns, the first answer per survey in each."""
    paired = answers.join(questions, "question_id")
    return to_wide(paired, on, "question", "answer", order, names)


def interview_view(
    parts: list[DataFrame], on: list[str], questions: DataFrame | None = None,
    answers: DataFrame | None = None, order: str = "_seq", names: list[str] | None = None,
) -> DataFrame | None:
    """One row per survey: the parts' first known values fully joined on their keys, with one column per question.

    Only parts that hold all keys take part. All are stacked and grouped in one exchange, so parts cannot multiply each other;
    ``order`` tells which row comes first, or all columns of a part without it. Answers without questions are a part like
    others; questions alone are shown as they are if nothing else is. None if nothing qualifies.
    """
    both = questions is not None and answers is not None
    parts = [*parts, *([answers] if answers is not None and not both else [])]
    usable = [_ordered(p, on, order) for p in parts if set(on) <= set(p.columns)]
    if both:
        paired = answers.join(questions, "question_id")
        if names is None:
            # The questions become columns, so their names are needed to make the plan.
            names = [r[0] for r in paired.select("question").dropna().distinct().orderBy("question").collect()]
        told = [F.when(F.col("question") == name, F.col("answer")).alias(name) for name in names]
        usable.append((paired.select(*on, *told, order), order))
    return stacked_groups(usable, on) if usable else questions


def _ordered(part: DataFrame, on: list[str], order: str) -> tuple[DataFrame, Column | str]:
    """A part and what tells its first row: the order column, or all columns without it."""
    columns = [c for c in part.columns if c not in on]
    return part, order if order in columns else F.struct(*columns) if columns else F.lit(0)
