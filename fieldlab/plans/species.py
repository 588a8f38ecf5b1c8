"""Ranking of preferred species from free text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlab.functions.text import SPECIES_SPELLINGS, commas, spelled, tidy
from fieldlab.operators.aggregates import ranked_counts, top_categories
from fieldlab.operators.reshape import split_rows


def preferred_species(
    df: DataFrame, column: str, spellings: dict[str, str] = SPECIES_SPELLINGS
) -> DataFrame:
    """Species named in delimited answers, spelled one way, one row per mention."""
    listed = df.select(tidy(commas(column)).alias("species"))
    named = split_rows(listed, "species")
    return named.withColumn("species", spelled("species", spellings))


def species_ranking(
    df: DataFrame, column: str, top: int | None = 6, without: str = "non-angler",
    spellings: dict[str, str] = SPECIES_SPELLINGS,
) -> DataFrame:
    """Most frequent species, one answer excluded from the ranking."""
    named = preferred_species(df, column, spellings).filter(F.col("species") != without)
    return ranked_counts(named, "species") if top is None else top_categories(named, "species", top)
