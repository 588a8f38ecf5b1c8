"""Language identification by compression: the dictionary that packs a text best names its language.

``learned`` takes a bounded sample of labelled rows, ``DOCS_PER_LANGUAGE`` per language in the order of a hash of doc_id,
and joins each language's texts to a raw-content dictionary of at most ``DICTIONARY_BYTES``. ``identified`` compresses every
whole text, in consecutive blocks of ``BLOCK`` bytes so that a long text does not become its own dictionary, with each
dictionary and sums the sizes. Both see words only: lower case, everything but letters one space.

Null texts, empty texts and texts without letters are ``und`` with score 0. Ties go to the language with more labelled
documents, then to the smaller name. Rows without label teach nothing. Repeated rows get equal results. An empty table gives an
empty table; without any labelled row every text is ``und``. Other columns are kept, output columns are replaced.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlab.llm.frames import arrow_map, texts_of

UNKNOWN = "und"
#: Bound of the sample that the dictionaries are made of.
DOCS_PER_LANGUAGE = 64
#: Longer texts give this many of their first characters to the dictionary (they are classified whole).
CHARS_PER_DOC = 3000
DICTIONARY_BYTES = 96 * 1024
BLOCK = 2048
LEVEL = 6
#: ``accepted``: the least score of any text; texts from so many letters on need this share of the score that all but ``STRAY`` of
#: the labelled texts of their length reach.
LEAST_MARGIN = 0.001
LENGTHS = (40, 200)
STRAY, SHARE = 0.01, 0.7

_OTHER = regex.compile(r"[^\p{L}]+")


def plain(text: str) -> str:
    """The words in lower case between single spaces; a single space if there is no letter."""
    return _OTHER.sub(" ", f" {text.lower()} ")


def learned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> list[tuple[str, bytes]]:
    """Languages, the most frequent first, and their dictionaries. The driver gets the bounded sample only.

    Of a language with too few texts of 200 characters or more, shorter ones are taken too.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    known = [r[0] for r in rows.groupBy(lang).count().orderBy(F.desc("count"), lang).collect()]
    short = F.char_length(text) < 200
    order = Window.partitionBy("lang").orderBy("short", "spread", "id")
    narrow = rows.select(
        F.col(lang).alias("lang"), short.alias("short"), F.xxhash64(F.col(doc_id).cast("string")).alias("spread"),
        F.col(doc_id).alias("id"),
    )
    chosen = narrow.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= DOCS_PER_LANGUAGE)
    ids = [r[0] for r in chosen.select("id").distinct().collect() if r[0] is not None]
    texts = (
        rows.where(F.col(doc_id).isin(ids))
        .select(F.col(lang).alias("lang"), F.col(doc_id).alias("id"), F.substring(text, 1, CHARS_PER_DOC).alias("text"))
        .distinct()
        .collect()
    )
    made = []
    for name in known:
        parts = [r["text"] for r in sorted((r for r in texts if r["lang"] == name), key=lambda r: (r["id"], r["text"]))]
        made.append((name, "".join(map(plain, parts)).encode()[:DICTIONARY_BYTES]))
    return made


@lru_cache(maxsize=2)
def compressors(dictionaries: tuple[tuple[str, bytes], ...], level: int):
    made = []
    for name, raw in dictionaries:
        content = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=level)
        pack = zstandard.ZstdCompressor(level=level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False)
        made.append((name, pack))
    return made


def classified(text: str, packs) -> tuple[str, float]:
    """The best language and by what share of its bytes the second best was larger."""
    words = plain(text)
    if not packs or words == " ":
        return UNKNOWN, 0.0
    raw = words.encode()
    blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
    sizes = [sum(len(pack.compress(b)) for b in blocks) for _, pack in packs]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    second = min((s for i, s in enumerate(sizes) if i != best), default=2 * sizes[best])
    return packs[best][0], min(1.0, max(0.0, (second - sizes[best]) / second))


def identified(docs: DataFrame, dictionaries: list[tuple[str, bytes]], text: str = "text") -> DataFrame:
    """Add lang_pred and score to every row."""
    kept = docs.drop("lang_pred", "score")
    schema = T.StructType(list(kept.schema.fields)).add("lang_pred", "string").add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(tuple(dictionaries))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        packs = compressors(shared.value, LEVEL)
        found = [classified(t, packs) for t in texts_of(batch.column(text))]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            names=schema.names,
        )

    return arrow_map(kept, run, schema)


def margins(docs: DataFrame, dictionaries: list[tuple[str, bytes]], doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[float, ...]:
    """Least scores by length, from ``LENGTHS`` letters on: what the labelled rows reach that no dictionary was made of.

    Every labelled row of ``LENGTHS[-1]`` characters or more counts, but the ``DOCS_PER_LANGUAGE`` first ones per language, which the
    dictionaries hold. Their first letters are scored, for each length. Scores are quotients of small sizes, so that the exact
    percentile counts few distinct values, however many rows there are.
    """
    rows = docs.where(F.col(lang).isNotNull() & (F.char_length(text) >= LENGTHS[-1]))
    narrow = rows.select(F.col(lang).alias("lang"), F.xxhash64(F.col(doc_id).cast("string")).alias("spread"), F.col(doc_id).alias("id"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("spread", "id"))
    taught = narrow.withColumn("rank", place).where(F.col("rank") <= DOCS_PER_LANGUAGE)
    ids = [r[0] for r in taught.select("id").distinct().collect() if r[0] is not None]
    others = rows.where(F.col(doc_id).isNull() | ~F.col(doc_id).isin(ids))
    texts = others.select(F.substring(text, 1, CHARS_PER_DOC).alias("text"))
    parts = [texts.select(F.lit(i).alias("length"), F.substring("text", 1, size + size // 2).alias("text")) for i, size in enumerate(LENGTHS)]
    scored = identified(parts[0].unionByName(parts[1]), dictionaries)
    found = dict(scored.groupBy("length").agg(F.percentile("score", F.lit(STRAY))).collect())
    return tuple(max(LEAST_MARGIN, SHARE * found.get(i, 0.0)) for i in range(len(LENGTHS)))


def accepted(least: tuple[float, ...] = (LEAST_MARGIN, LEAST_MARGIN), text: str = "text") -> Column:
    """Whether a language was found by more than a narrow margin; ``least`` as ``margins`` tells it."""
    size = F.char_length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    needed = F.when(size >= LENGTHS[1], least[1]).when(size >= LENGTHS[0], least[0]).otherwise(LEAST_MARGIN)
    return (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= needed)
