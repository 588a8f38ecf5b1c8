"""License scans by diagonal voting. DataFrame functions only.

Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z in lower case. Base labels come from places where
a phrase's words stand one after the other. Labels of the method come from license templates: all rolling word k-grams of all
texts are joined to the templates' k-grams; each hit votes for a diagonal, the offset between text and template; neighbouring
diagonals (up to ``GAP`` words were put in or left out) are merged to spans; a span counts if its k-grams, compared word by
word, cover at least ``COVER`` of the template within ``STRETCH`` times its length.

The templates are a fixed list of a few hundred words, so their k-grams are broadcast.

Null and empty texts have no words and no labels. Rows that repeat doc_id and text get equal results, rows with one doc_id and
different texts are kept apart by the text's key. Ties do not arise: labels are a set. An empty table gives an empty table. Other
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlab.llm.frames import keyed_texts

# Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Notices of well-known public licenses, by label.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
     "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or "
     "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
     "OF ANY KIND, either express or implied."),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
     "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
     "furnished to do so, subject to the following conditions"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
]

#: Words of a k-gram.
GRAM = 5
#: Largest step between merged diagonals.
GAP = 2
#: Least share of a template's words that a span covers, and its largest length as a multiple of the template's.
COVER, STRETCH = 0.8, 1.3

_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text in lower case."""
    return F.transform(F.array_remove(F.split(text, _SEPARATOR), ""), F.lower)


def rolling(found: Column | str) -> Column:
    """The k-gram from each word on; shorter ones at the end, which no template has."""
    column = F.col(found) if isinstance(found, str) else found
    return F.transform(column, lambda w, i: F.concat_ws(" ", w, *(F.get(column, i + k) for k in range(1, GRAM))))


def template_grams(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """label, template, place, size (words of the template), gram and its hash."""
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string")
    listed = rows.select("template", "label", words(F.col("text")).alias("words"))
    return (
        listed.select("template", "label", F.size("words").alias("size"), F.posexplode(rolling("words")).alias("place", "t_gram"))
        .where(F.col("place") <= F.col("size") - GRAM)
        .withColumn("t_hash", F.xxhash64("t_gram"))
    )


def spans(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Verified spans of keyed texts: doc_id, n, label, template, first_word, n_words, cover."""
    texts = docs.select("doc_id", "n", words(F.col("text")).alias("words"))
    grams = texts.select("doc_id", "n", F.posexplode(rolling("words")).alias("at", "gram")).withColumn("hash", F.xxhash64("gram"))
    known = F.broadcast(template_grams(docs.sparkSession, templates))
    hits = grams.join(known, (F.col("hash") == F.col("t_hash")) & (F.col("gram") == F.col("t_gram")))
    key = ["doc_id", "n", "template"]
    votes = hits.groupBy(*key, "label", "size", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    ordered = Window.partitionBy(*key).orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(ordered) > GAP
    merged = (
        votes.withColumn("new", F.coalesce(step, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key, "label", "size", "span")
        .agg(F.flatten(F.collect_list("places")).alias("places"), F.min("first").alias("first"), F.max("last").alias("last"))
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + GRAM - 1)))))
    length = F.col("last") - F.col("first") + GRAM
    return merged.select(
        "doc_id", "n", "label", "template", F.col("first").cast("long").alias("first_word"), length.cast("long").alias("n_words"),
        (covered / F.col("size")).alias("cover"), (length <= STRETCH * F.col("size") + GAP).alias("fits"),
    ).where((F.col("cover") >= COVER) & F.col("fits")).drop("fits")


def base(docs: DataFrame) -> DataFrame:
    """Counts and places of the base phrases of keyed texts."""
    listed = docs.select("doc_id", "n", F.array_remove(F.split("text", _SEPARATOR), "").alias("words"))
    # Every phrase has this word; texts without it need no search.
    hinted = F.exists("words", lambda w: F.lower(w) == "license")
    joined = F.when(hinted, F.concat(F.lit(" "), F.lower(F.array_join("words", " ")), F.lit(" ")))
    lined = listed.select("doc_id", "n", F.size("words").cast("long").alias("n_words"), joined.alias("line"))

    def spaces(text: Column) -> Column:
        return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))

    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        inside = F.contains("line", F.lit(f" {phrase} "))
        counts.append(F.when(inside, F.regexp_count("line", F.lit(f"(?<= ){phrase}(?= )"))).otherwise(0))
        firsts.append(F.when(inside, spaces(F.substring_index("line", f" {phrase} ", 1))))
        lasts.append(F.when(inside, F.col("n_words") - len(phrase.split()) - spaces(F.substring_index("line", f" {phrase} ", -1))))
        labels.append(F.when(inside, F.lit(label)))
    return lined.select(
        "doc_id", "n", "n_words",
        reduce(lambda a, b: a + b, counts).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("found"),
    )


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is 1 with a base phrase, else the largest share of a template that a span covers, else 0.
    """
    keyed = keyed_texts(docs, doc_id, text)
    own = spans(keyed, templates).groupBy(F.col("doc_id").alias("_id"), F.col("n").alias("_n")).agg(
        F.collect_set("label").alias("more"), F.max("cover").alias("cover")
    )
    joined = base(keyed).join(own, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("n") == F.col("_n")), "left")
    every = F.array_union("found", F.coalesce("more", F.array().cast("array<string>")))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
    )
