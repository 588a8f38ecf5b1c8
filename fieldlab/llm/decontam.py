"""Benchmark decontamination by latent semantic retrieval.

1. *Passages* are consecutive windows of ``PASSAGE`` words of every whole document; words (lower-cased A-Z) are hashed to
   ``FEATURES`` columns.
2. *Randomised SVD.* With T the passages' term counts, D the inverse document frequencies and R a sparse random matrix of signs,
   one pass over all passages sums S = T'T R and the document frequencies. Y = D S is then a sketch of A'A for A = T D, and the
   Nystroem form Y (R'S)^-1 Y' gives A's leading right singular vectors and values on the driver, whose matrices have
   FEATURES x RANK numbers, whatever the corpus. Sums are of integers, so they do not depend on their order.
3. *Candidates.* Overlapping passages and benchmark items are projected to the latent space, each direction scaled by its
   singular value; pairs of cosine ``COSINE`` or more are candidates. Passages move on by ``BLOCK`` words and come in lengths of
   2, 4, 8, ... blocks; an item is compared with those about as long as itself. Items are worked on in groups of ``ITEM_BLOCK``.
4. *Checks.* A candidate goes on if the words around the passage can hold enough of the item at all (by bit sets of words, then
   by counts). It is a leak if the longest common subsequence holds ``OVERLAP`` of the item's words within ``SPREAD`` times its length,
   and ``ANSWER_OVERLAP`` of the item's last ``ANSWER`` words, where its answer stands.

Null texts and items are empty and match nothing; items without words neither. Repeated documents get equal results, repeated
items give a row each. Of several places of one item in a document the one with the most common words is told, the first of equals.
Null ids are ids like others. An empty table gives an empty table. Other columns are ignored by ``leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlab.llm import kernels as K
from fieldlab.llm.frames import arrow_map, bytes_of, slices, text_key

PASSAGE = 48
FEATURE_BITS = 14
FEATURES = 1 << FEATURE_BITS
RANK = 64
COSINE = 0.4
#: Words by which passages move on; the shortest passage has two blocks.
BLOCK = 8
OVERLAP, SPREAD = 0.6, 1.5
ANSWER, ANSWER_OVERLAP = 8, 0.5
#: Benchmark items that are sent to the tasks at once.
ITEM_BLOCK = 20_000
#: Rows of S that are summed together.
_STRIPE = 256
#: Bits of a word set, in 64-bit numbers.
_SET = 16


def _signs() -> tuple[np.ndarray, np.ndarray]:
    """R: every feature has one entry, its column and its sign."""
    chance = np.random.default_rng(7)
    return chance.integers(0, RANK, FEATURES), chance.integers(0, 2, FEATURES) * 2.0 - 1.0


def _features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a buffer, their columns, and where each text's words begin."""
    _, _, first, hashes = K.word_hashes(K.lowered(data), at)
    return hashes, (hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64), first


def _cuts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins of consecutive windows of every text, and the texts they belong to."""
    count = -(-np.diff(first) // size)
    owner = np.repeat(np.arange(len(count)), count)
    step = K.ranges(np.zeros(len(count), np.int64), count)
    return first[:-1][owner] + step * size, owner


def gathered_counts(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray, np.ndarray]:
    """Number of passages, document frequencies and S of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column, sign = _signs()
        total = np.zeros((RANK, FEATURES))
        frequency = np.zeros(FEATURES, np.int64)
        passages = 0
        for batch in batches:
            data, at = bytes_of(batch.column(0))
            for a, b in slices(at, 1 << 20):
                _, columns, first = _features(data[at[a] : at[b]], at[a : b + 1] - at[a])
                if not len(columns):
                    continue
                begin, _ = _cuts(first, PASSAGE)
                passages += len(begin)
                sizes = np.diff(np.append(begin, len(columns)))
                of = np.repeat(np.arange(len(begin)), sizes)
                cell = column[columns] * len(begin) + of
                projected = np.bincount(cell, sign[columns], len(begin) * RANK).reshape(RANK, -1)
                order = np.argsort(columns.astype(np.uint16), kind="stable")  # passages stay in order within a column
                ranked, where = columns[order], of[order]
                new = np.ones(len(order), bool)
                new[1:] = ranked[1:] != ranked[:-1]
                head = np.flatnonzero(new)
                for row, into in zip(projected, total):  # one direction at a time stays in the processor's cache
                    into[ranked[head]] += np.add.reduceat(row[where], head)
                new[1:] |= where[1:] != where[:-1]
                frequency += np.bincount(ranked[new], minlength=FEATURES)
        if passages:
            rows = np.concatenate([frequency[:, None], total.T.astype(np.int64)], axis=1)
            for i in range(0, FEATURES, _STRIPE):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i // _STRIPE], pa.int32()), pa.array([passages if i == 0 else 0], pa.int64()), pa.array([rows[i : i + _STRIPE].tobytes()], pa.binary())],
                    names=["stripe", "passages", "sums"],
                )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for stripe, passages, sums in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = held.setdefault(stripe, [0, np.zeros(_STRIPE * (RANK + 1), np.int64)])
                own[0] += passages
                own[1] += np.frombuffer(sums, np.int64)
        for stripe, (passages, sums) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([stripe], pa.int32()), pa.array([passages], pa.int64()), pa.array([sums.tobytes()], pa.binary())],
                names=["stripe", "passages", "sums"],
            )

    schema = "stripe int, passages long, sums binary"
    parts = docs.select(F.col(text).alias("text")).mapInArrow(run, schema)
    rows = parts.repartition("stripe").mapInArrow(added, schema).collect()  # FEATURES x RANK numbers at any size
    whole = np.zeros((FEATURES, RANK + 1), np.int64)
    for row in rows:
        whole[row["stripe"] * _STRIPE : (row["stripe"] + 1) * _STRIPE] = np.frombuffer(row["sums"], np.int64).reshape(_STRIPE, -1)
    return sum(r["passages"] for r in rows), whole[:, 0], whole[:, 1:].astype(np.float64)


def latent_space(passages: int, frequency: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Weights (a row per latent direction) that turn term counts into coordinates of unit scale: idf * right singular vectors / singular values."""
    idf = np.log1p(passages / (1.0 + frequency))
    column, sign = _signs()
    core = np.zeros((RANK, RANK))
    np.add.at(core, column, sign[:, None] * sums)
    core = (core + core.T) / 2
    values, vectors = np.linalg.eigh(core)
    good = values > max(values.max(initial=0.0), 1e-12) * 1e-9
    half = (idf[:, None] * sums) @ (vectors[:, good] / np.sqrt(values[good]))
    left, size, _ = np.linalg.svd(half, full_matrices=False)
    good = size > size.max(initial=0.0) * 1e-6
    return np.ascontiguousarray((idf[:, None] * left[:, good] / size[good]).T.astype(np.float32))


def common_words(item: list[int], words: list[int]) -> list[int]:
    """Places in ``words`` of a longest common subsequence with the item."""
    p, q = np.array(item, np.uint64), np.array(words, np.uint64)
    table = np.zeros((len(p) + 1, len(q) + 1), np.int32)
    for i in range(len(p)):
        hit = np.where(q == p[i], table[i, :-1] + 1, 0)
        table[i + 1, 1:] = np.maximum.accumulate(np.maximum(table[i, 1:], hit))
    places, i, j = [], len(p), len(q)
    while i and j:
        if table[i, j] == table[i, j - 1]:
            j -= 1
        elif table[i, j] == table[i - 1, j]:
            i -= 1
        else:
            places.append(j - 1)
            i, j = i - 1, j - 1
    return places[::-1]


def common_length(item: list[int], masks: dict[int, int], words: list[int]) -> int:
    """Length of the longest common subsequence, bits of one number standing for the item's words."""
    full = (1 << len(item)) - 1
    state = full
    for w in words:
        mask = masks.get(w)
        if mask:
            up = state & mask
            state = ((state + up) | (state - up)) & full
    return len(item) - state.bit_count()


class Item:
    """A benchmark item as word hashes."""

    def __init__(self, item_id, text: str):
        raw = text.encode()
        data = np.frombuffer(raw, np.uint8)
        self.id = item_id
        hashes, self.columns, _ = _features(data, np.array([0, len(data)]))
        self.words = hashes.tolist()
        self.masks: dict[int, int] = {}
        for i, w in enumerate(self.words):
            self.masks[w] = self.masks.get(w, 0) | 1 << i
        self.answer = self.words[-ANSWER:]
        self.count = {w: m.bit_count() for w, m in self.masks.items()}
        self.bits = _word_set(hashes, np.zeros(len(hashes), np.int64), 1)[0]
        #: The passages that it is compared with have 2 << scale blocks.
        self.scale = max(0, int(np.ceil(np.log2(len(self.words) / (3 * BLOCK)))) if self.words else 0)

    def checked(self, words: list[int]) -> tuple[int, int, float, float] | None:
        """Begin and end of the item in the words, shares of its words and of its answer's; none if it is not there."""
        size = len(self.words)
        if sum(self.count[w] for w in self.count.keys() & set(words)) < OVERLAP * size:
            return None
        if common_length(self.words, self.masks, words) < OVERLAP * size:
            return None
        places = common_words(self.words, words)
        # The densest part that still holds enough of the item.
        need = int(np.ceil(OVERLAP * size))
        best = None
        for i in range(len(places) - need + 1):
            span = places[i + need - 1] - places[i] + 1
            if best is None or span < best[0]:
                best = (span, i)
        if best is None or best[0] > SPREAD * size:
            return None
        middle = (places[best[1]] + places[best[1] + need - 1]) // 2
        near = [p for p in places if abs(p - middle) <= SPREAD * size / 2 + 1]
        answer = len(common_words(self.answer, words[max(0, near[0] - 2) : near[-1] + ANSWER + 1])) / len(self.answer)
        return (near[0], near[-1] + 1, len(near) / size, answer) if answer >= ANSWER_OVERLAP else None


def _word_set(hashes: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Bit sets of the words of each owner, as rows of 64-bit numbers."""
    flags = np.zeros((size, _SET * 64), np.uint8)
    flags[owner, (hashes & np.uint64(_SET * 64 - 1)).astype(np.int64)] = 1
    return np.packbits(flags, axis=1).view(np.uint64)


def _around(sets: np.ndarray, before: int, size: int) -> np.ndarray:
    """Union of ``size`` (a power of two) consecutive sets, from ``before`` ahead of each."""
    rows = len(sets)
    padded = np.concatenate([np.zeros((before, _SET), np.uint64), sets, np.zeros((size, _SET), np.uint64)])
    span = 1
    while span < size:
        padded = padded[:-span] | padded[span:]
        span *= 2
    return padded[:rows]


class Items:
    """Items of one scale: their latent vectors of unit length and word sets."""

    def __init__(self, items: list[Item], scale: int, weights: np.ndarray):
        self.items, self.blocks = items, 2 << scale
        vectors = np.stack([weights[:, i.columns].sum(axis=1) for i in items])
        self.vectors = vectors / np.maximum(np.sqrt((vectors * vectors).sum(axis=1)), 1e-12)[:, None]
        self.bits = np.stack([i.bits for i in items])
        size = np.array([len(i.words) for i in items])
        kept = np.bitwise_count(self.bits).sum(axis=1)
        #: Bits that a place must share: equal words and equal bits of the item count once.
        self.least = np.ceil(OVERLAP * size) - (size - kept)


def _leaks_of(columns: np.ndarray, hashes: np.ndarray, first: np.ndarray, weights: np.ndarray, groups: list[Items]):
    """(text, item, begin, end, cosine, share, answer) of every leak in a buffer's texts."""
    begin, owner = _cuts(first, BLOCK)
    if not len(begin):
        return
    sums = np.zeros((len(weights), len(begin) + 1))
    for k, row in enumerate(weights):
        np.cumsum(np.add.reduceat(row[columns], begin), out=sums[k, 1:])
    last = np.searchsorted(owner, owner, "right")
    number = np.arange(len(begin))
    block = np.repeat(number, np.diff(np.append(begin, len(columns))))
    sets = _word_set(hashes, block, len(begin))
    for group in groups:
        until = np.minimum(number + group.blocks, last)
        passage = np.stack([(row[until] - row[:-1]).astype(np.float32) for row in sums])
        passage /= np.maximum(np.sqrt((passage * passage).sum(axis=0)), 1e-12)
        margin = group.blocks * 3 // 2  # an item is at most 3/2 of its passages long
        near = _around(sets, margin, group.blocks * 4)
        found: dict[tuple[int, int], tuple] = {}
        for low in range(0, len(begin), 2048):
            cosine = passage[:, low : low + 2048].T @ group.vectors.T
            rows, which = np.nonzero(cosine >= COSINE)
            shared = np.bitwise_count(near[low + rows] & group.bits[which]).sum(axis=1)
            hold = np.flatnonzero(shared >= group.least[which])
            for r, k in zip(rows[hold].tolist(), which[hold].tolist()):
                text, item = int(owner[low + r]), group.items[k]
                lo = max(int(first[text]), int(begin[low + r]) - margin * BLOCK)
                hi = min(int(first[text + 1]), int(begin[low + r]) + (group.blocks + margin) * BLOCK)
                told = float(cosine[r, k])
                before = found.get((text, k))
                if before is not None and before[3] == 1.0:  # nothing is better than a whole item
                    found[text, k] = (*before[:2], max(told, before[2]), *before[3:])
                    continue
                result = item.checked(hashes[lo:hi].tolist())
                if result is None:
                    continue
                a, b, share, answer = result
                a, b = a + lo - int(first[text]), b + lo - int(first[text])
                if before is None or share > before[3]:
                    found[text, k] = (a, b, told if before is None else max(told, before[2]), share, answer)
        for (text, k), (a, b, told, share, answer) in found.items():
            yield text, group.items[k], a, b, told, share, answer


LEAKS = "doc_id long, n int, item_id long, first_word int, end_word int, cosine double, overlap double, answer_overlap double"


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for every benchmark item found in a document: ids, the text's key, the words it takes, cosine and overlaps."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("n"), F.col(text).alias("text"))
    weights = latent_space(*gathered_counts(docs, text))
    sent = spark.sparkContext.broadcast(weights)
    blocks = []
    for low in range(0, max(1, benchmark.count()), ITEM_BLOCK):
        block = _item_block(benchmark, low)
        if block:
            blocks.append(_searched(narrow, sent, spark.sparkContext.broadcast(block)))
    if not blocks:
        return spark.createDataFrame([], LEAKS)
    found = blocks[0]
    for more in blocks[1:]:
        found = found.unionByName(more)
    return found


def _item_block(benchmark: DataFrame, low: int) -> list[tuple]:
    """ITEM_BLOCK items at most, in order of id and text."""
    rows = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    if low == 0 and rows.limit(ITEM_BLOCK + 1).count() <= ITEM_BLOCK:
        return [tuple(r) for r in rows.collect()]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.orderBy("item_id", "text")))
    return [tuple(r)[:2] for r in ranked.where((F.col("_rank") > low) & (F.col("_rank") <= low + ITEM_BLOCK)).collect()]


def _searched(narrow: DataFrame, weights, block) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = weights.value
        items = [i for i in (Item(*b) for b in block.value) if i.words]
        if not items or not len(space):
            return
        groups = [Items([i for i in items if i.scale == k], k, space) for k in sorted({i.scale for i in items})]
        for batch in batches:
            data, at = bytes_of(batch.column("text"))
            rows = []
            for a, b in slices(at, 1 << 18):
                hashes, columns, first = _features(data[at[a] : at[b]], at[a : b + 1] - at[a])
                rows += [(a + t, item.id, *rest) for t, item, *rest in _leaks_of(columns, hashes, first, space, groups)]
            if rows:
                take = pa.array([r[0] for r in rows])
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("n").take(take)]
                    + [pa.array([r[i + 1] for r in rows], kind) for i, kind in enumerate(kinds)],
                    names=["doc_id", "n", "item_id", "first_word", "end_word", "cosine", "overlap", "answer_overlap"],
                )

    return narrow.mapInArrow(run, LEAKS)


def without_leaks(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents in which nothing was found."""
    named = found.select(F.col("doc_id").alias("__leak_id"), F.col("n").alias("__leak_n")).distinct()
    on = F.col(doc_id).eqNullSafe(F.col("__leak_id")) & (text_key(text) == F.col("__leak_n"))
    return docs.join(named, on, "left_anti")
