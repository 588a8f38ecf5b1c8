"""Acoustic detections: coordinate repair, tag registry, recaptures and activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlab.functions.geo import ddm_to_degrees, west_negative
from fieldlab.functions.text import after_dash
from fieldlab.functions.times import serial_date
from fieldlab.operators.aggregates import keep_first, ranked_counts
from fieldlab.operators.joins import mapped_once, merge_inner
from fieldlab.operators.shape import fix_headers
from fieldlab.operators.skew import ranked
from fieldlab.sources.workbooks import labelled_value, promote_header

# Fixed value: longitudes west of this are outside the study area.
WESTERN_BOUND = -123.0


def repair_coordinates(detections: DataFrame, stations: DataFrame) -> DataFrame:
    """Replace coordinates of out-of-bounds or missing longitudes from the station registry.

    ``stations`` has ``station_label``, ``station_lat`` and ``station_lon`` as degrees and decimal minutes. Of a label
    that is listed more than once, the first row by latitude, then longitude (as text, nulls last) counts, so that
    detections are never multiplied. Rows on the bound and rows without longitude are kept. All longitudes end up negative.
    """
    once = keep_first(stations.dropna(subset=["station_label"]), ["station_label"], ["station_lat", "station_lon"])
    known = once.select(
        F.col("station_label").alias("receiver_name"),
        ddm_to_degrees("station_lat").alias("_lat"),
        ddm_to_degrees("station_lon").alias("_lon"),
    )
    named = detections.withColumn("receiver_name", after_dash("receiver"))
    joined = named.join(known, "receiver_name", "left")
    bad = F.col("longitude").isNull() | (F.col("longitude") < WESTERN_BOUND)
    return joined.withColumns(
        {
            "latitude": F.when(bad, F.coalesce("_lat", "latitude")).otherwise(F.col("latitude")),
            "longitude": west_negative(
                F.when(bad, F.coalesce("_lon", "longitude")).otherwise(F.col("longitude"))
            ),
        }
    ).select("receiver_name", *detections.columns)


def sale_sheet(cells: DataFrame, header_row: int, names: list[str], label: str = "Date:") -> DataFrame:
    """Complete rows of a tag sale sheet with the sheet's sale date beside them."""
    rows = promote_header(cells, header_row, names).dropna("any", subset=fix_headers(names))
    date = labelled_value(cells, label, 2, "_serial")
    dated = rows.join(date, ["file", "sheet"], "left")
    return dated.withColumn("date_sold", serial_date("_serial")).drop("_serial")


def tag_registry(sheets: list[DataFrame], detections: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Detected transmitters with the first registry row that knows them."""
    return mapped_once(detections.select(key).distinct(), sheets, key, order)


def recaptured(marks: DataFrame, recaptures: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Recaptures with the first marking of the same tag; other equal columns get suffixes."""
    return merge_inner(keep_first(marks.dropna(subset=[key]), [key], order), recaptures, key)


def times_seen(matched: DataFrame, key: str) -> DataFrame:
    return ranked_counts(matched, key, "times")


def activity(detections: DataFrame, moment: str, station: str, transmitter: str) -> DataFrame:
    """Detection counts by station, day, hour, transmitter and station by transmitter, with ranks.

    One grouping by station, transmitter, day and hour reads the detections; the five reports
    are sums over it.
    """
    base = detections.groupBy(
        F.col(station).alias("_s"),
        F.col(transmitter).cast("string").alias("_t"),
        F.to_date(moment).cast("string").alias("_d"),
        F.hour(moment).cast("string").alias("_h"),
    ).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("string")
    reports = {
        "station": (F.col("_s"), none),
        "day": (F.col("_d"), none),
        "hour": (F.col("_h"), none),
        "transmitter": (F.col("_t"), none),
        "station_transmitter": (F.col("_s"), F.col("_t")),
    }
    parts = [
        F.struct(F.lit(name).alias("report"), value.alias("value"), other.alias("transmitter"))
        for name, (value, other) in reports.items()
    ]
    long = base.select(F.inline(F.array(*parts)), "n")
    counted = long.groupBy("report", "value", "transmitter").agg(F.sum("n").alias("n"))
    # One row per distinct value is left by now; ranks come from an ordered scan over the distinct counts.
    return ranked(counted, ["report"], "-n", "rank")
