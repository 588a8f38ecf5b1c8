"""Quality rules of documents and of their hosts.

``measures`` counts what the rules need from each whole text. ``host_verdicts`` aggregates rule failures by host, shrinks
each host's failure rate with a beta prior fitted to all hosts, and ``judged`` joins the verdicts back to the documents.

Words are runs of anything but space and the characters 9 to 13. Null texts have no words and fail. Null hosts are one
host. Repeated rows count as often as they stand. An empty table gives an empty table. Other columns are kept by
``measures`` if named in ``keep``, and ignored otherwise. Ties do not arise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlab.llm import kernels as K
from fieldlab.llm.frames import arrow_map, bytes_of, free, slices

#: Least words of a document.
MIN_WORDS = 10
#: Most words in repeated 5-word windows, in hundredths of all words.
MOST_REPEATED = 20
#: Words of a window.
WINDOW = 5
#: Symbols per 100 words, and repeated lines per 100 lines, that count as a failure of a document at its host.
HOST_SYMBOLS, HOST_LINES = 50, 50
#: A host's documents go if the shrunk rate of failures at the host is above this.
MOST_FAILING = 0.5
#: Documents that the prior counts for at least, however far hosts lie apart; a host's only document never decides alone.
LEAST_STRENGTH = 2.0
#: Hot hosts are spread over this many parts when verdicts are joined back.
PARTS = 32

_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeated(hashes: np.ndarray) -> int:
    """Words inside windows that are found twice or more in the text."""
    found = K.grams(hashes, WINDOW)
    if len(found) < 2:
        return 0
    order = np.argsort(found, kind="stable")
    same = found[order[1:]] == found[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(found), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), bool)
    for i in range(WINDOW):
        covered[i : i + len(found)] |= twice
    return int(covered.sum())


def counts(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text of a buffer."""
    begin, end, first, hashes = K.word_hashes(data, at)
    n = len(at) - 1
    made = {name: np.zeros(n, np.int64) for name in _COUNTS}
    made["n_words"] = np.diff(first)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[at])

    blank = (data == 32) | ((data >= 9) & (data <= 13))
    made["word_chars"] = per_text(((data & 0xC0) != 0x80) & ~blank)
    made["n_symbols"] = per_text(_SYMBOLS[data])
    raw = data.tobytes()
    for i in range(n):
        lines = [line for line in raw[at[i] : at[i + 1]].split(b"\n") if line.strip()]
        made["n_lines"][i] = len(lines)
        made["n_dup_lines"][i] = len(lines) - len(set(lines))
        made["n_repeat_words"][i] = _repeated(hashes[first[i] : first[i + 1]])
    return made


def measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """The kept columns and the counts of each whole text."""
    narrow = docs.select(*keep, F.col(text).alias("_text"))
    schema = T.StructType([narrow.schema[name] for name in keep])
    for name in _COUNTS:
        schema = schema.add(name, "long")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, at = bytes_of(batch.column("_text"))
        parts = [counts(data[at[a] : at[b]], at[a : b + 1] - at[a]) for a, b in slices(at)]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in keep), *(pa.array(np.concatenate([p[c] for p in parts])) for c in _COUNTS)],
            names=schema.names,
        )

    return arrow_map(narrow, run, schema)


def base_failed() -> Column:
    """The rules of a document on its own."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def host_failed() -> Column:
    """What counts against a host: the base rules, many symbols, or many repeated lines."""
    return (
        base_failed()
        | (100 * F.col("n_symbols") > HOST_SYMBOLS * F.col("n_words"))
        | (100 * F.col("n_dup_lines") > HOST_LINES * F.col("n_lines"))
    )


def host_verdicts(measured: DataFrame, host: str = "source", most: float = MOST_FAILING) -> DataFrame:
    """``host``, n_docs, n_failed, rate (shrunk) and host_failed for every host.

    The beta prior has the mean m of all documents' failures, and the strength that the hosts' variance leaves beside the
    binomial variance of their sizes (method of moments, weighted by size); without such variance hosts do not differ, and
    all have the mean. Sums are of integers and of sums over hosts, so results do not depend on the partitioning beyond
    the last digits of the rate.
    """
    hosts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(host_failed().cast("long")).alias("n_failed")
    )
    n, f = F.col("n_docs"), F.col("n_failed")
    prior = hosts.agg(
        F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("all_docs"), F.sum(f).alias("all_failed"),
        F.sum(f * f / n).alias("squares"), F.sum(n * n).alias("sizes"),
    ).select(
        (F.col("all_failed") / F.col("all_docs")).alias("m"),
        F.when(
            F.col("hosts") > 1,
            # between-host variance by moments: (S - (k - 1) m (1 - m)) / (N - sum n^2 / N - (k - 1))
            (
                F.col("squares")
                - F.col("all_failed") * F.col("all_failed") / F.col("all_docs")
                - (F.col("hosts") - 1) * (F.col("all_failed") / F.col("all_docs")) * (1 - F.col("all_failed") / F.col("all_docs"))
            )
            / F.nullif(F.col("all_docs") - F.col("sizes") / F.col("all_docs") - (F.col("hosts") - 1), F.lit(0.0)),
        ).alias("between"),
    ).select(
        "m",
        F.when(F.col("between") > 0, F.greatest(F.col("m") * (1 - F.col("m")) / F.col("between") - 1, F.lit(LEAST_STRENGTH))).alias("strength"),
    )
    # One row beside every host: the prior.
    rate = F.when(F.col("strength").isNull(), F.col("m")).otherwise(
        (f + F.col("strength") * F.col("m")) / (n + F.col("strength"))
    )
    return (
        hosts.join(F.broadcast(prior), F.lit(True), "left")
        .select("host", "n_docs", "n_failed", rate.alias("rate"))
        .withColumn("host_failed", F.coalesce(F.col("rate") > most, F.lit(False)))
    )


def judged(measured: DataFrame, verdicts: DataFrame, host: str = "source") -> DataFrame:
    """Measured documents with base_failed, host_rate, host_failed and kept. Hot hosts are salted."""
    part = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(PARTS)).cast("int")
    own, its_host, its_part = (free(name, measured) for name in ("_part", "_host", "_hpart"))
    spread = verdicts.select(
        F.col("host").alias(its_host), F.col("rate").alias("host_rate"), F.col("host_failed"),
        F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias(its_part),
    )
    return (
        measured.withColumn(own, part)
        .join(spread, (F.col(own) == F.col(its_part)) & F.col(host).eqNullSafe(F.col(its_host)), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("host_failed"), F.lit(False)))
        .drop(own, its_part, its_host)
    )
