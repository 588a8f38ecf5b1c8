"""Nest surveys: coordinates in one system, activity text, outcome report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlab.functions.geo import coordinate_kind, lonlat_to_utm, ordered_utm
from fieldlab.functions.numbers import to_number
from fieldlab.functions.text import fragments, nest_activity
from fieldlab.operators.aggregates import counts
from fieldlab.operators.maintain import with_added_columns
from fieldlab.operators.stats import bins_histogram

# Reasons read from comments and activity, first match wins.
UNDESTROYED_REASONS = [
    ("comments", r"couldn.?t locate", "Couldn't Locate"),
    ("comments", r"old nest", "Old Nest"),
    ("activity", r"no fry captured", "No Fry Captured"),
]


def normalise_nests(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Decimal degrees, UTM metres in either order and blanks as one easting/northing pair."""
    kind = coordinate_kind(lat)
    from_degrees = lonlat_to_utm(to_number(lon), to_number(lat))
    from_metres = ordered_utm(lat, lon)
    pick = lambda i: F.when(kind == "degrees", from_degrees[i]).when(kind == "utm", from_metres[i])
    return df.withColumns({"kind": kind, "easting": pick(0), "northing": pick(1)}).drop(lat, lon)


def describe_activity(df: DataFrame, destroyed: str, fry: str) -> DataFrame:
    """Outcome and fry codes as one activity text."""
    return df.withColumn("activity", nest_activity(destroyed, fry))


def with_place_comments(df: DataFrame, location: str, substrate: str, comments: str = "comments") -> DataFrame:
    """Comments followed by where the nest is and on what; missing parts are left out."""
    on = F.when(F.col(substrate).isNotNull(), F.concat(F.lit(". Substrate: "), F.col(substrate)))
    text = F.concat(F.concat_ws(" ", comments, location), F.coalesce(on, F.lit("")))
    return df.withColumn(comments, F.nullif(text, F.lit(""))).drop(location)


def append_nests(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored nests with a batch that may bring new columns, such as the substrate and invasive species; older rows have none."""
    return with_added_columns(stored, batch)


def outcome_status(df: DataFrame, activity: str) -> DataFrame:
    """Rows that tell whether a nest was destroyed, labelled."""
    status = F.when(F.col(activity).contains("Nest not destroyed"), "Not Destroyed").when(
        F.col(activity).contains("Nest destroyed"), "Destroyed"
    )
    return df.withColumn("status", status).filter(F.col("status").isNotNull())


def fragment_counts(df: DataFrame, activity: str) -> DataFrame:
    """How often each sentence of the activity text occurs."""
    return counts(df.select(F.explode(fragments(activity)).alias("fragment")), "fragment")


def outcome_reasons(df: DataFrame, comments: str, activity: str) -> DataFrame:
    """Inferred reason for every labelled nest."""
    columns = {"comments": comments, "activity": activity}
    reason = F.lit("Other")
    for source, pattern, label in reversed(UNDESTROYED_REASONS):
        reason = F.when(F.col(columns[source]).rlike(f"(?i){pattern}"), label).otherwise(reason)
    return df.withColumn("reason", reason)


def outcome_report(df: DataFrame, status: str, substrate: str, depth: str) -> dict[str, DataFrame]:
    """Status by substrate, and status by depth bin."""
    return {
        "substrate": counts(df, substrate, status),
        "depth": bins_histogram(df, depth, 30, [status]),
    }
