"""Angler origin, age structure and awareness questions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlab.functions.geo import haversine_km
from fieldlab.functions.text import SITE_REASONS, categorise
from fieldlab.operators.aggregates import counts, distance_bins, keep_first, shares
from fieldlab.operators.stats import box_stats, density


def origin_distances(
    interviews: DataFrame, keys: list[str], order: list[str], postcodes: DataFrame
) -> DataFrame:
    """Distinct upper-case postcodes of interviews with their distance to the lake.

    ``postcodes`` is the look-up of ``post_code``, ``lat`` and ``lon``; codes it does not know
    drop out.
    """
    one = keep_first(interviews, keys, order).filter(F.col("post_code").isNotNull())
    distinct = one.select(F.upper("post_code").alias("post_code")).distinct()
    placed = distinct.join(postcodes.filter(F.col("lat").isNotNull()), "post_code")
    return placed.withColumn("distance_km", haversine_km("lat", "lon"))


def origin_bins(interviews: DataFrame, keys: list[str], order: list[str], postcodes: DataFrame):
    """Number of postcodes per 50 km of distance."""
    return distance_bins(origin_distances(interviews, keys, order, postcodes), "distance_km")


class Reports(Mapping):
    """Named reports that are built on look-up, so that unused ones start no jobs."""

    def __init__(self, builders: dict):
        self._builders = builders

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def age_structure(
    df: DataFrame, age: str, length: str, sex: str, grid: int = 512
) -> Mapping[str, DataFrame]:
    """Counts and shares by age, length-at-age box figures, length density by sex, counts by sex; each is made when it is asked for."""
    return Reports(
        {
            "ages": lambda: shares(df, age, scale=1.0, name="share"),
            "length_at_age": lambda: box_stats(df, [age], length),
            "density": lambda: density(df, [sex], length, grid),
            "sexes": lambda: counts(df, sex),
        }
    )


def answer_shares(df: DataFrame, question: str, question_id, answer: str, digits: int | None = 1):
    """Share of each answer to one question."""
    return shares(df.filter(F.col(question) == question_id), answer, digits=digits)


def reason_shares(
    df: DataFrame, question: str, question_id, answer: str, digits: int | None = 1,
    rules: list[tuple[str, str]] = SITE_REASONS,
):
    """Share of each reason category among the free-text answers to one question."""
    asked = df.filter(F.col(question) == question_id)
    return shares(asked.select(categorise(answer, rules).alias("reason")), "reason", digits=digits)
