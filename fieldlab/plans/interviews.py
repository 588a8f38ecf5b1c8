"""Interview main sheet: cleaning, question and answer tables, catch reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlab.functions.numbers import to_number
from fieldlab.functions.times import (
    at_clock,
    date_of_serial,
    hours_between,
    seconds_of_serial,
    serial_date,
    serial_numbers,
    serial_seconds,
    shift_parts,
    undo_auto_date,
)
from fieldlab.operators.aggregates import first_known, reconcile
from fieldlab.operators.reshape import to_long
from fieldlab.operators.sets import tagged
from fieldlab.operators.shape import coalesce_synonyms, matching
from fieldlab.operators.skew import row_counts
from fieldlab.operators.windows import renumber_within, run_ids, spread_collisions


def clean_main(
    raw: DataFrame, order: str = "_seq", synonyms: dict[str, list[str]] | None = None
) -> DataFrame:
    """Main sheet as typed rows, one per survey.

    Rows of one (survey, date, time) collapse to their first known values; surveys are numbered
    1..n within each date; equal timestamps move apart by 5 minutes; shift text becomes start,
    end and hours; wind ranges that became dates turn back into text.
    """
    dated = raw.filter(F.col("date").isNotNull()).withColumn("date", serial_date("date"))
    if synonyms:
        dated = coalesce_synonyms(dated, synonyms)
    keys = ["survey_number", "date", "time"]
    one = first_known(dated, keys, order)
    one = one.withColumn("_number", to_number("survey_number"))
    moment = at_clock("date", serial_seconds("time"))
    # Within a date the new numbers follow the sheet's, so collisions are told apart in the order that gave the numbers.
    order_of = ["_number", "_given", "_clock"]
    one = one.withColumns({"_given": F.col("survey_number"), "_clock": F.col("time"), "time": moment})
    numbered = renumber_within(one, "date", order_of, "survey_number")
    timed = numbered.withColumn("wind", undo_auto_date("wind"))
    spread = spread_collisions(timed, "time", ["date", *order_of], source=one).drop(*order_of)
    shift = shift_parts("shift")
    return spread.withColumns(
        {
            "shift_start_time": at_clock("date", shift["shift_start"]),
            "shift_end_time": at_clock("date", shift["shift_end"]),
            "hours_worked": hours_between(shift["shift_start"], shift["shift_end"]),
        }
    )


def clean_sheet(
    raw: DataFrame, order: str = "_seq", moment: str = "date_time", synonyms: dict[str, list[str]] | None = None
) -> DataFrame:
    """A sheet beside the main one (demography, fish, counts): one serial of date and time per row.

    It becomes ``date`` and ``time``; rows without a date are left out; surveys are numbered 1..n within each date in sheet order
    into ``survey_number``; equal times of a date move apart by 5 minutes.
    """
    if synonyms:
        raw = coalesce_synonyms(raw, synonyms)
    # Exploded, as a filter would be pushed below the column and read each text twice.
    told = raw.withColumn("_serial", F.explode(serial_numbers(moment)))
    day = date_of_serial("_serial")
    dated = told.withColumns({"date": day, "time": at_clock(day, seconds_of_serial("_serial"))}).drop(moment, "_serial")
    dated = dated.drop("survey_number")
    counts = row_counts(dated, "date", "time")
    numbered = renumber_within(dated, "date", [order], "survey_number", counts)
    return spread_collisions(numbered, "time", ["date", order], source=dated, counts=counts)


def question_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """Question columns with ids in sheet order."""
    rows = [(i, c) for i, c in enumerate(columns, start=1)]
    return df.sparkSession.createDataFrame(rows, "question_id long, question string")


def answer_table(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """One row per survey and question; the id is the question's place among the columns."""
    place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("question"))
    long = to_long(df, ids, columns, "question", "answer")
    return long.select(*ids, place.alias("question_id"), "answer")


def answers_by_run(df: DataFrame, ids: list[str], day: str, columns: list[str]) -> DataFrame:
    """Answers with their question and the run of their date; runs follow the dates."""
    long = answer_table(df, [*ids, day], columns)
    questions = question_table(df, columns)
    return run_ids(long.join(questions, "question_id"), day, "run").select(*ids, day, "run", "question_id", "question", "answer")


# Which columns of the main sheet the older layout kept in which table.
OLDER_SPLITS = {
    "shifts": r"^(surveyor|shift|site)",
    "weather": r"^(air_temp|cloud|wind|precip)",
    "fishing_details": r"^(vessel|number_(anglers|rods)|total_person_hr|preferred)",
    "catch": r"^(number_.*_[cr]$|total_fish|total_retained|release_reason)",
}


def older_main_splits(df: DataFrame, key: str) -> dict[str, DataFrame]:
    """The main sheet as the older layout's tables: the key and the columns that belong to each; tables without columns are left out."""
    chosen = {name: [c for c in matching(df, pattern) if c != key] for name, pattern in OLDER_SPLITS.items()}
    return {name: df.select(key, *columns) for name, columns in chosen.items() if columns}


def catch_reconciliation(
    df: DataFrame, caught: tuple[list[str], str], retained: tuple[list[str], str], by: list[str]
) -> DataFrame:
    """Caught and retained component sums against their reported totals."""
    return tagged(
        {"caught": reconcile(df, *caught, by=by), "retained": reconcile(df, *retained, by=by)}, "kind"
    )
