"""Queries of the operators over the given tables, and SQL where SQL gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlab.llm import bpe, chat, decontam, fptree, html, language, licenses, neardup, onepermutation, passages, quality, suffixes, trie
from fieldlab.llm.frames import table
from fieldlab.session import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql.strip()
        return build

    return add


def public_vocabulary() -> str:
    """Place of the public tokenizer file that the contract names."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = bpe.encode_decode(docs, public_vocabulary())
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        bpe.ids_sha256("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


_ESC = r"regexp_replace({0}, '([<\[])(\\*)(/?s>|/?INST\]|\|[A-Za-z_]*\|>)', '\1\\\2\3', 'g')"


@query(
    "op5_chat",
    rf"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-1::BIGINT, 0::BIGINT, 'user', '</s>[INST] ok [/INST]'),
                       (-1::BIGINT, 1::BIGINT, 'assistant', '</s>[INST] ok [/INST]')),
    sized AS (
      SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
        length({_ESC.format("replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n')")})
          + length({_ESC.format("text")}) + length('<|turn|>' || chr(10) || '<|end|>') AS chars
      FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
    summed AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS prefix FROM sized)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
      coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
      (sum(prefix) FILTER (role = 'assistant' OR i = n))::BIGINT AS formatted_chars
    FROM summed GROUP BY conv_id
    """,
)
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], given.schema)
    examples = chat.format_chat(given.unionByName(added))
    said = F.transform(chat.read_turns("formatted"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = examples.select(
        "conv_id", "example",
        F.when(F.col("last"), F.array_join(said, "")).alias("turns"),
        F.when(F.col("last"), F.size(said).cast("long")).alias("n"),
        F.when(F.col("trainable"), chat.read_loss(examples)).alias("loss"),
        F.char_length("formatted").alias("chars"),
    )
    loss = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda e: F.coalesce(e["loss"], F.lit(""))), "")
    return (
        read.groupBy("conv_id")
        .agg(
            F.max("n").alias("n_turns"),
            F.sha2(F.max("turns"), 256).alias("turns_sha256"),
            loss.alias("loss"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
        )
    )


def held_out() -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = language.learned(docs.where(~held_out()))
    texts = docs.select("doc_id", "text", held_out().alias("held_out"))
    return language.identified(texts, dictionaries).select("doc_id", "held_out", "lang_pred", "score")


_SPACE = r"[ \t\n\v\f\r]+"


@query(
    "op10_quality",
    rf"""
    WITH d AS (
      SELECT doc_id, source, coalesce(text, '') AS text,
        list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda w: w <> '') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '{_SPACE}', '', 'g') <> '') AS lines
      FROM documents),
    w AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM d WHERE len(words) >= 5),
    c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 4], ' ')) AS k FROM w),
    r AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM c, range(0, 5) t(o) WHERE k > 1 GROUP BY 1),
    m AS (
      SELECT d.doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
      FROM d LEFT JOIN r ON r.doc_id = d.doc_id),
    j AS (
      SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words AS base_failed,
        n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words
          OR 100 * n_symbols > {quality.HOST_SYMBOLS} * n_words OR 100 * n_dup_lines > {quality.HOST_LINES} * n_lines AS failed FROM m),
    h AS (SELECT source, count(*) AS n, count(*) FILTER (failed) AS f FROM j GROUP BY 1),
    a AS (SELECT count(*) AS k, sum(n)::DOUBLE AS n, sum(f)::DOUBLE AS f, sum(f * f / n) AS squares, sum(n * n)::DOUBLE AS sizes FROM h),
    b AS (SELECT f / n AS m, (squares - f * f / n - (k - 1) * (f / n) * (1 - f / n)) / nullif(n - sizes / n - (k - 1), 0) AS between_hosts FROM a),
    p AS (SELECT m, CASE WHEN between_hosts > 0 THEN greatest(m * (1 - m) / between_hosts - 1, {quality.LEAST_STRENGTH}) END AS strength FROM b),
    v AS (SELECT source, CASE WHEN strength IS NULL THEN m ELSE (f + strength * m) / (n + strength) END AS rate FROM h, p)
    SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND NOT coalesce(rate > {quality.MOST_FAILING}, false) AS kept, j.source AS host, round(rate, 6) AS host_rate
    FROM j JOIN v ON v.source IS NOT DISTINCT FROM j.source
    """,
)
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = written(quality.measures(table(spark, sf_dir, "documents")))
    return quality.judged(measured, quality.host_verdicts(measured)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.col("source").alias("host"), F.round("host_rate", 6).alias("host_rate"),
    )


@query("op1_html")
def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extracted(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _phrase_sql() -> str:
    """Places of the base phrases in the words of ``d``."""
    parts = []
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        hit = " AND ".join(f"lower(words[i + {k}]) = '{w}'" for k, w in enumerate(own))
        parts.append(f"SELECT doc_id, i - 1 AS pos, '{label}' AS label FROM d, unnest(range(1, len(words) + {2 - len(own)})) t(i) WHERE {hit}")
    return " UNION ALL ".join(parts)


def _template_sql() -> str:
    """The templates' k-grams as rows."""
    rows = []
    for i, (label, text) in enumerate(licenses.TEMPLATES):
        own = [w.lower() for w in re.findall("[0-9A-Za-z]+", text)]
        rows += [f"({i}, '{label}', {len(own)}, {k}, '{' '.join(own[k : k + licenses.GRAM])}')" for k in range(len(own) - licenses.GRAM + 1)]
    return "(VALUES " + ", ".join(rows) + ") t(template, label, size, place, gram)"


@query(
    "op3_licenses",
    rf"""
    WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_WORDS}'), lambda w: w <> '') AS words FROM documents),
    base AS (SELECT doc_id, count(*) AS n, min(pos) AS lo, max(pos) AS hi, list(DISTINCT label) AS labels FROM ({_phrase_sql()}) GROUP BY 1),
    grams AS (SELECT doc_id, i - 1 AS pos, lower(array_to_string(words[i:i + {licenses.GRAM - 1}], ' ')) AS gram
      FROM d, unnest(range(1, len(words) - {licenses.GRAM - 2})) t(i) WHERE len(words) >= {licenses.GRAM}),
    hits AS (SELECT doc_id, template, label, size, pos, place, pos - place AS diagonal FROM grams JOIN {_template_sql()} USING (gram)),
    votes AS (SELECT doc_id, template, label, size, diagonal, list(DISTINCT place) AS places, min(pos) AS lo, max(pos) AS hi
      FROM hits GROUP BY ALL),
    stepped AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER w > {licenses.GAP}, true)::INT AS new FROM votes
      WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)),
    spanned AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM stepped),
    merged AS (SELECT doc_id, template, label, size, span, min(lo) AS lo, max(hi) AS hi,
        len(list_distinct(flatten(list(flatten(list_transform(places, lambda p: range(p, p + {licenses.GRAM}))))))) AS covered
      FROM spanned GROUP BY ALL),
    kept AS (SELECT doc_id, label, covered / size AS cover FROM merged
      WHERE covered / size >= {licenses.COVER} AND hi - lo + {licenses.GRAM} <= {licenses.STRETCH} * size + {licenses.GAP}),
    own AS (SELECT doc_id, list(DISTINCT label) AS labels, max(cover) AS cover FROM kept GROUP BY 1)
    SELECT doc_id, len(words) AS n_words, coalesce(base.n, 0) AS n_base, base.lo AS first_word, base.hi AS last_word,
      array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
      array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ',') AS labels,
      CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(own.cover, 0)::DOUBLE END AS score
    FROM d LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)
    """,
)
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


@query("op8_suffixes")
def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = suffixes.deduplicated(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return made.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(
    "op9_neardup",
    rf"""
    WITH RECURSIVE d AS (
      SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}'), lambda w: w <> '') AS words
      FROM documents),
    s AS (
      SELECT DISTINCT doc_id, array_to_string(words[i:i + {neardup.SHINGLE - 1}], ' ') AS shingle
      FROM d, unnest(range(1, greatest(len(words) - {neardup.SHINGLE - 1}, 1) + 1)) t(i) WHERE len(words) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS l, b.doc_id AS r, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
    e AS (
      SELECT l, r FROM p JOIN n x ON x.doc_id = l JOIN n y ON y.doc_id = r WHERE 100 * k >= {neardup.SHARE} * (x.n + y.n - k)),
    both_ways AS (SELECT l, r FROM e UNION ALL SELECT r, l FROM e),
    reached AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT reached.doc_id, r FROM reached JOIN both_ways ON other = l)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(other) AS component_id, d.doc_id = min(other) AS kept
    FROM d JOIN reached USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id, n.n
    """,
)
def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = neardup.grouped(table(spark, sf_dir, "documents"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return made.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


@query("op4_decontam")
def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaks: one row per document and benchmark item found in it."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n")


@query("op6_passages")
def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages: one row per passage of a document and an earlier document that has it."""
    return passages.repeated(table(spark, sf_dir, "documents")).drop("n", "source_n")


_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op13_ranked",
    rf"""
    WITH d AS (
      SELECT row_number() OVER () AS k, doc_id, list_filter(regexp_split_to_array({_ASCII_LOWER.format("coalesce(text, '')")}, '{_WORDS}'), lambda w: w <> '') AS words FROM documents),
    i AS (
      SELECT row_number() OVER () AS j, item_id, list_distinct(list_filter(regexp_split_to_array({_ASCII_LOWER.format("coalesce(text, '')")}, '{_WORDS}'), lambda w: w <> '')) AS words FROM benchmark),
    t AS (SELECT count(*) FILTER (len(words) > 0)::BIGINT AS n, sum(len(words))::BIGINT AS l FROM d),
    p AS (SELECT k, unnest(words) AS term FROM d),
    f AS (SELECT k, term, count(*)::BIGINT AS tf FROM p GROUP BY 1, 2),
    w AS (SELECT term, floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, t GROUP BY term, n),
    q AS (SELECT j, item_id, unnest(words) AS term FROM i),
    s AS (
      SELECT j, q.item_id, d.doc_id, k, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(words)::BIGINT * n) // l))))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN w USING (term) JOIN d USING (k), t GROUP BY ALL)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY j ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= {fptree.TOP}
    """,
)
def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fptree.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_fingerprints")
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = onepermutation.edited(table(spark, sf_dir, "documents"))
    marked = made.withColumn("edited_fingerprint", onepermutation.fingerprint("edited"))
    return marked.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        onepermutation.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        onepermutation.likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)))"""


@query(
    "op12_trie",
    rf"""
    WITH t AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
    r AS (
      SELECT c.conv_id, 0 AS part, place, role, text FROM c JOIN t ON t.conv_id = base AND place <= h
      UNION ALL SELECT c.conv_id, 1, place, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND place > h),
    m AS (
      SELECT conv_id, row_number() OVER w AS depth, string_agg(md5(length(role) || ':' || role || text), '') OVER w AS key,
        len(list_filter(regexp_split_to_array(text, '{_SPACE}'), lambda w: w <> '')) AS words
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    p AS (SELECT conv_id, depth, key, words FROM m UNION ALL SELECT conv_id, 0, '', 0 FROM c),
    n AS (SELECT key, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words, (count(*) - 1) * min(words) AS saved FROM p GROUP BY key),
    k AS (SELECT left(key, length(key) - 32) AS key, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
    u AS (
      SELECT p.key, sum(saved)::BIGINT AS saved_tokens, (count(*) FILTER (k.n IS NULL))::BIGINT AS n_leaves
      FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN k ON k.key = n.key GROUP BY 1),
    z AS (SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest FROM p WHERE (conv_id, depth) IN (SELECT (conv_id, max(depth)) FROM p GROUP BY conv_id) GROUP BY 1)
    SELECT n.conv_id, n.depth, b.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, n_leaves, saved_tokens,
      coalesce(digest, sha256('')) AS ends_sha256
    FROM n LEFT JOIN n b ON n.depth > 0 AND b.key = left(n.key, length(n.key) - 32) LEFT JOIN k ON k.key = n.key JOIN u ON u.key = n.key LEFT JOIN z ON z.key = n.key
    """,
)
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_trie(table(spark, sf_dir, "conversations"))
