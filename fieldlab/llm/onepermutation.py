"""Document fingerprints by one-permutation MinHash. DataFrame functions only.

A text's set holds its 5-word shingles (words between white space, in lower case); a text of fewer words is one shingle, a text
without words has none.

1. *One permutation.* Every shingle is hashed once to 64 bits. The upper 8 bits are its bin, and a bin keeps its smallest hash.
   The hashes are sorted together with one mark per bin, larger than any hash of the bin; the first entry of
   each bin is then its smallest hash, or the mark of an empty bin.
2. *Optimal densification.* An empty bin takes over the hash of a bin that is not empty. Each bin has its own order of all bins,
   (first + k * step) mod 256 with an odd step drawn per bin, and takes the first full one in it. The order does not depend on the
   text, so two texts agree in a filled bin as often as in a full one. ``TRIES`` places are looked up; for the few
   bins left, the full bin of the smallest rank in the order is taken, which is the same choice.
3. *Packing.* A bin's hash is mixed with the bin's number, the low ``BITS`` bits are kept, 16 bins to a 64-bit word, the words as hex.
4. *Bias correction.* Two bins agree by chance with probability c = 2 ** -BITS; from the share s of equal bins, likeness is
   (s - c) / (1 - c), not below 0.

The standard error of a likeness is about 0.03 at most. Equal texts have equal fingerprints.

``edited`` pairs each row with the next one in descending doc_id (after the last: the first) by an ordered scan: texts are shuffled
once, by consecutive pieces of doc_id; a piece's first row is also sent to the piece before, one row per piece.

Null and empty texts have no shingle; their fingerprint is a word of ``-`` and their likeness is 1 to each other and 0 to other texts. Rows
with null doc_id come last, rows of one doc_id in the order of their text's hash; repeated rows are rows of their own. Very long
texts are one array of hashes in a task. An empty table gives an empty table. Other columns stay out of the work.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlab.operators.skew import _PIECE, with_pieces

SHINGLE = 5
#: Bins (the upper 8 bits of a hash), low bits kept of each, and bins in a packed word.
BINS, BITS = 256, 4
PER_WORD = 64 // BITS
#: Places of a bin's order that are looked up before the smallest rank is searched.
TRIES = 6
#: Fingerprint of a text without words.
EMPTY = "-"

_MARK = (1 << 56) - 1
_RANDOM = np.random.default_rng(20_260_611)
#: Per bin, the first place and the odd step of its order.
FIRSTS = _RANDOM.integers(0, BINS, BINS).tolist()
STEPS = (2 * _RANDOM.integers(0, BINS // 2, BINS) + 1).tolist()
#: Steps back: rank of bin i in bin j's order is (i - first_j) * back_j mod 256.
BACKS = [pow(s, -1, BINS) for s in STEPS]


def _let(value: str, name: str, body: str) -> str:
    """SQL of ``body`` with ``value`` under a name, made once: optimizers may copy a column into a lambda, not a bound variable."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _numbers(values: list[int]) -> str:
    return "array(" + ", ".join(map(str, values)) + ")"


def shingle_hashes(text: str) -> str:
    """SQL of the 64-bit hashes of a text's shingles, repeats included; empty without words."""
    words = f"filter(split(lower({text}), '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"
    hashes = f"transform({words}, w -> xxhash64(w))"
    rest = ", ".join(f"h[i + {k}]" for k in range(1, SHINGLE))
    rolling = f"transform(slice(h, 1, greatest(size(h) - {SHINGLE - 1}, 0)), (x, i) -> xxhash64(x, {rest}))"
    short = f"transform(slice(array(0), 1, IF(size(h) > 0, 1, 0)), x -> xxhash64(concat('short', array_join(transform(h, y -> CAST(y AS STRING)), ' '))))"
    return _let(hashes, "h", f"IF(size(h) >= {SHINGLE}, {rolling}, {short})")


def binned(hashes: str) -> str:
    """SQL of the bins' smallest hashes, the mark in empty ones. Bins follow each other as signed numbers do."""
    marks = f"transform(sequence(0, {BINS - 1}), b -> shiftleft(CAST(b - {BINS // 2} AS BIGINT), 56) | {_MARK}L)"
    every = f"sort_array(concat({hashes}, {marks}))"
    return _let(every, "v", "filter(v, (x, i) -> i = 0 OR shiftright(x, 56) <> shiftright(v[greatest(i, 1) - 1], 56))")


def densified(bins: str) -> str:
    """SQL of the bins with empty ones filled, each by the first full bin of its order."""
    full = lambda x: f"({x} & {_MARK}L) <> {_MARK}L"
    tries = []
    for k in range(TRIES):
        place = f"d[({{first}} + {k} * {{step}}) & {BINS - 1}]"
        tries.append((place, full(place)))
    cases = " ".join(f"WHEN {test} THEN {place}" for place, test in tries)
    cases = cases.replace("{first}", "firsts[j]").replace("{step}", "steps[j]")
    # Of the full bins, the one of the smallest rank; hashes carry their bin in the upper bits.
    rank = f"((CAST(shiftright(x, 56) AS INT) + {BINS // 2} - firsts[j]) * backs[j]) & {BINS - 1}"
    nearest = f"aggregate(f, named_struct('r', {BINS}, 'x', 0L), (a, x) -> IF({rank} < a.r, named_struct('r', {rank}, 'x', x), a)).x"
    filled = f"transform(d, (own, j) -> CASE WHEN {full('own')} THEN own {cases} ELSE {nearest} END)"
    named = _let(_numbers(FIRSTS), "firsts", _let(_numbers(STEPS), "steps", _let(_numbers(BACKS), "backs", filled)))
    return _let(bins, "d", _let(f"filter(d, x -> {full('x')})", "f", f"IF(size(f) = 0, array(), IF(size(f) = {BINS}, d, {named}))"))


def fingerprint(text: str) -> Column:
    """The fingerprint of a text column (null: empty) as hex words."""
    mixed = f"transform({densified(binned(shingle_hashes('t')))}, (x, j) -> xxhash64(x, j) & {2**BITS - 1})"
    word = " | ".join(f"shiftleft(b[w + {k}], {BITS * k})" for k in range(PER_WORD))
    packed = f"array_join(transform(sequence(0, {BINS - PER_WORD}, {PER_WORD}), w -> lpad(hex({word}), 16, '0')), '')"
    return F.expr(_let(f"coalesce({text}, '')", "t", _let(mixed, "b", f"IF(size(b) = 0, '{EMPTY}', {packed})")))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of the texts of two fingerprint columns, from 0 to 1."""
    words = BINS // PER_WORD
    # conv gives an unsigned number as text; the halves fit a signed one.
    half = lambda c: f"CAST(conv(substring({c}, 1 + 8 * i, 8), 16, 10) AS BIGINT)"
    ones = int("1" * 8, 16)
    folds = "x"
    for shift in (1, 2)[: BITS // 2]:
        folds = f"(({folds}) | shiftright({folds}, {shift}))"
    unequal = f"bit_count({_let(f'{half('p')} ^ {half('q')}', 'x', folds)} & {ones}L)"
    count = f"aggregate(sequence(0, {2 * words - 1}), 0, (n, i) -> n + {unequal})"
    chance = 2.0**-BITS
    share = f"(1.0D - {count} / {float(BINS)}D - {chance}D) / {1 - chance}D"
    told = f"CASE WHEN p = '{EMPTY}' AND q = '{EMPTY}' THEN 1.0D WHEN p = '{EMPTY}' OR q = '{EMPTY}' THEN 0.0D WHEN p = q THEN 1.0D ELSE greatest(0.0D, {share}) END"
    return F.expr(_let(a, "p", _let(b, "q", told)))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """doc_id and the columns, and ``next_<column>`` of the next row in descending doc_id; after the last row, the first."""
    order = ["-doc_id", "_hash"]
    rows = docs.select("doc_id", *columns).withColumn("_hash", F.xxhash64("text"))
    keys = docs.select("doc_id", F.xxhash64("text").alias("_hash"))
    placed = with_pieces(rows, order, keys=keys)
    narrow = with_pieces(keys, order)
    # The first row of every piece goes to the piece before as well, that of the first piece to the last one. Both tables have a
    # row per piece.
    heads = narrow.groupBy(_PIECE).agg(
        F.min_by(F.struct("doc_id", "_hash"), F.struct(F.col("doc_id").isNull(), -F.col("doc_id").cast("decimal(20,0)"), "_hash")).alias("_head")
    )
    line = Window.orderBy(_PIECE)
    whole = Window.partitionBy()
    before = heads.select(
        F.col("_head.doc_id").alias("_id"), F.col("_head._hash").alias("_h"),
        F.coalesce(F.lag(_PIECE).over(line), F.max(_PIECE).over(whole)).alias("_to"),
    )
    known = (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("_hash") == F.col("_h"))
    joined = placed.join(F.broadcast(before), known, "left").drop("_id", "_h")
    own = F.struct(F.col(_PIECE).alias("_piece"), F.lit(False).alias("_copy"))
    also = F.struct(F.col("_to").alias("_piece"), F.lit(True).alias("_copy"))
    sent = joined.withColumn("_place", F.explode(F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, also))))
    dealt = sent.select("doc_id", "_hash", *columns, "_place._piece", "_place._copy")
    here = Window.partitionBy(_PIECE).orderBy("_copy", F.col("doc_id").desc_nulls_last(), "_hash")
    following = {f"next_{c}": F.lead(c).over(here) for c in columns}
    return dealt.withColumns(following).where("NOT _copy").drop(_PIECE, "_copy", "_hash")


def edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, edited, fingerprint and next_fingerprint: each text, and it with its last half replaced by the next text's first."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    paired = with_next(named.withColumn("fingerprint", fingerprint("text")), ["text", "fingerprint"])
    half = F.floor(F.char_length("text") / 2).cast("int")
    made = F.concat(F.left("text", F.char_length("text") - half), F.left("next_text", half))
    return paired.select("doc_id", "text", made.alias("edited"), "fingerprint", "next_fingerprint")


def fingerprinted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns and ``fingerprint``, with an underscore in front as often as the name is taken."""
    name = "fingerprint"
    while name in docs.columns:
        name = f"_{name}"
    return docs.withColumn(name, fingerprint(f"`{text}`"))
