"""Near-duplicate documents by MinHash with tensored banding; candidates are verified on full shingle sets.

A document's set holds its distinct 5-word shingles (lower-cased A-Z, words between white space); a shorter text is one shingle,
a text without words has none and is linked with nothing.

*Signature.* Two collections, A and B, of ``SUBKEYS`` sub-keys with ``ROWS`` minhashes each. A table's key is a pair (A_i, B_j), so
``SUBKEYS ** 2`` tables of ``2 * ROWS`` rows come from ``2 * SUBKEYS * ROWS`` minhashes, about the square root of what separate tables
need. With similarity s, p = s ** ROWS, two documents meet in a table with probability (1 - (1 - p) ** SUBKEYS) ** 2, which is
over 0.9999 at 0.85 and over 0.999 at 0.80.

*Classes.* Documents with equal sets are one class; only its smallest doc_id goes on.

*Links.* Sub-keys that one class alone has are left out first; tables are formed from the others. In each table bucket every
class meets the smallest one (a star, so that pairs grow with documents). Verified links give components. Then, in buckets whose
members are not all in the component of the smallest, the strays are compared with every member of another component by
sketches, large buckets in shards, and plausible pairs are verified. No bucket is capped. A sketch keeps the smallest hash of a
set in each of ``BINS`` ranges, one byte each; it costs no minhash, and for short texts it is nearly the set itself.

*Components* by alternating large and small stars, each round written to the shared folder.

Null texts are empty. Rows with null doc_id are linked with nothing: null component, kept. Rows that share a doc_id are one
document with several texts: a link of any counts. Ties do not arise. An empty table gives an empty table. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlab.llm import kernels as K
from fieldlab.llm.frames import arrow_map, bytes_of, slices
from fieldlab.session import Workbench, written

SHINGLE = 5
#: Links need 100 * shared >= share * all; this is the share unless another is given.
SHARE = 85
#: Minhashes of a sub-key, and sub-keys of each of the two collections.
ROWS, SUBKEYS = 3, 12
HASHES = 2 * ROWS * SUBKEYS
#: Ranges of a sketch.
BINS = 256
#: Standard errors below the threshold at which a pair's sketches still count as plausible.
ERRORS = 4.5
#: Members of a bucket that one task compares its strays with.
SHARD = 20_000

_RANDOM = np.random.default_rng(20_240_501)
_MULTIPLY = _RANDOM.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_sets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles in ascending order, and where each text's begin."""
    _, _, first, hashes = K.word_hashes(K.lowered(data), at)
    count = np.diff(first)
    sizes = np.where(count >= SHINGLE, count - SHINGLE + 1, 0)
    every = K.grams(hashes, SHINGLE)
    owner = np.repeat(np.arange(len(count)), sizes)
    values = every[K.ranges(first[:-1], sizes)] if len(owner) else np.zeros(0, np.uint64)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        whole = [int(K.grams(hashes[first[i] : first[i + 1]], int(count[i]))[0]) for i in short]
        # One shingle of fewer words never equals one of five.
        values = np.concatenate([values, np.array(whole, np.uint64) ^ count[short].astype(np.uint64)])
        owner = np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    owner, values = owner[new], values[new]
    return values, np.searchsorted(owner, np.arange(len(count) + 1))


def signatures_of(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A row of minhashes (32 bits each) per text; zeros for empty sets."""
    made = np.zeros((len(start) - 1, HASHES), np.uint32)
    full = np.flatnonzero(np.diff(start))
    if len(full):
        heads = start[:-1][full]
        for k in range(HASHES):
            h = values * _MULTIPLY[k]
            h += _ADD[k]
            h >>= np.uint64(32)
            made[full, k] = np.minimum.reduceat(h.astype(np.uint32), heads)
    return made


def sketches_of(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A row of BINS bytes per text: one for the smallest hash in each range, 0 for an empty range."""
    made = np.zeros((len(start) - 1, BINS), np.uint8)
    owner = np.repeat(np.arange(len(start) - 1), np.diff(start))
    place = (values >> np.uint64(56)).astype(np.int64)
    first = np.ones(len(values), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
    made[owner[first], place[first]] = (values[first] % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    return made


SIGNED = "doc_id long, n_shingles long, digest binary, signature binary, sketch binary"


def signed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Set size, digest of the set and signature of each row."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, at = bytes_of(batch.column("text"))
        for a, b in slices(at, 1 << 19):
            values, start = shingle_sets(data[at[a] : at[b]], at[a : b + 1] - at[a])
            raw, made = values.tobytes(), signatures_of(values, start)
            digests = [hashlib.blake2b(raw[8 * x : 8 * y], digest_size=16).digest() for x, y in zip(start[:-1], start[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, b - a), pa.array(np.diff(start)), pa.array(digests, pa.binary()),
                    pa.array([m.tobytes() for m in made], pa.binary()),
                    pa.array([m.tobytes() for m in sketches_of(values, start)], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest", "signature", "sketch"],
            )

    return arrow_map(narrow, run, SIGNED)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), HASHES)


def _subkeys(signature: np.ndarray) -> np.ndarray:
    """Hashes of the 2 * SUBKEYS sub-keys; the sub-key's number is part of it."""
    parts = signature.reshape(len(signature), 2 * SUBKEYS, ROWS).astype(np.uint64)
    total = np.arange(2 * SUBKEYS, dtype=np.uint64)[None, :] + np.uint64(1)
    for r in range(ROWS):
        total = total * K.U(K.BASES[r % 2]) + parts[:, :, r]
    return K.mixed(total)


def _table_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A table's key from its two sub-keys; ``table_keys`` says the same in Spark's functions."""
    return a ^ ((b << np.uint64(31)) | (b >> np.uint64(33)))


def table_keys(classes: DataFrame) -> DataFrame:
    """key, rep: the table buckets of classes, without buckets that can only hold one."""

    def halves(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = _subkeys(_matrix(batch.column("signature")))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("rep").take(pa.array(np.repeat(np.arange(len(keys)), 2 * SUBKEYS))),
                pa.array(np.tile(np.arange(2 * SUBKEYS, dtype=np.int32), len(keys))), pa.array(keys.ravel().view(np.int64)),
            ],
            names=["rep", "half", "sub"],
        )

    subs = arrow_map(classes.select("rep", "signature"), halves, "rep long, half int, sub long")
    shared = subs.groupBy("sub").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("sub")
    met = subs.join(shared, "sub").groupBy("rep").agg(F.collect_list(F.struct("half", "sub")).alias("subs"))
    in_a, in_b = F.filter("subs", lambda s: s["half"] < SUBKEYS), F.filter("subs", lambda s: s["half"] >= SUBKEYS)
    return (
        met.select("rep", in_a.alias("a"), in_b.alias("b"))
        .select("rep", F.explode("a").alias("a"), "b")
        .select("rep", "a", F.explode("b").alias("b"))
        .select("rep", F.col("a.sub").bitwiseXOR(F.shiftleft("b.sub", 31).bitwiseOR(F.shiftrightunsigned("b.sub", 33))).alias("key"))
    )


def shingles_of(docs: DataFrame, wanted: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the set (packed hashes in ascending order) of the wanted documents."""
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(wanted, "doc_id", "left_semi")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, at = bytes_of(batch.column("text"))
        for a, b in slices(at, 1 << 19):
            values, start = shingle_sets(data[at[a] : at[b]], at[a : b + 1] - at[a])
            raw = values.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array([raw[8 * x : 8 * y] for x, y in zip(start[:-1], start[1:])], pa.binary()),
                ],
                names=["doc_id", "shingles"],
            )

    return arrow_map(chosen, run, "doc_id long, shingles binary")


def verified(pairs: DataFrame, sets: DataFrame, share: int = SHARE) -> DataFrame:
    """The pairs (l, r) whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("l"), F.col("shingles").alias("of_l"))
    right = sets.select(F.col("doc_id").alias("r"), F.col("shingles").alias("of_r"))
    both = pairs.join(left, "l").join(right, "r").select("l", "r", "of_l", "of_r")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("of_l"), batch.column("of_r")):
            p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            if 100 * min(len(p), len(q)) < share * max(len(p), len(q)):
                keep.append(False)
                continue
            if len(p) > len(q):
                p, q = q, p
            found = np.searchsorted(q, p)
            found[found == len(q)] = 0
            shared = int((q[found] == p).sum()) if len(q) else 0
            keep.append(100 * shared >= share * (len(p) + len(q) - shared))
        mask = pa.array(keep, pa.bool_())
        return batch.select(["l", "r"]).filter(mask)

    return arrow_map(both, run, "l long, r long").distinct()


def _plausible(size_l: np.ndarray, size_r: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int = SHARE) -> np.ndarray:
    """Whether sizes and sketches allow the threshold. A sketch samples ranges out of the union, without putting back."""
    share = percent / 100
    small, large = np.minimum(size_l, size_r), np.maximum(size_l, size_r)
    fits = np.flatnonzero(100 * small >= percent * large)
    a, b = left[fits], right[fits]
    seen = ((a | b) != 0).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    union = (size_l[fits] + size_r[fits]) / (1 + share)
    left_out = np.clip(1 - seen / union, 0.02, 1.0)
    error = np.sqrt(share * (1 - share) / np.maximum(seen, 1) * left_out)
    made = np.zeros(len(size_l), bool)
    made[fits] = same >= (share - ERRORS * error) * seen
    return made


def stray_pairs(buckets: DataFrame, classes: DataFrame, components: DataFrame, share: int = SHARE) -> DataFrame:
    """Pairs (l, r) of different components that share a bucket and have plausible sketches; each is told by one bucket."""
    placed = buckets.join(components, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    # A bucket's main component is that of its smallest class; strays are all others.
    mixed = (
        placed.groupBy("key")
        .agg(F.min(F.struct("rep", "component")).alias("main"), F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("many"))
        .where("lo <> hi")
        .select("key", F.col("main.component").alias("main"), F.ceil(F.col("many") / SHARD).cast("int").alias("shards"))
    )
    about = placed.join(mixed, "key")
    shard = F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int")
    stray = F.col("component") != F.col("main")
    columns = ["key", "rep", "component", "shard", "stray"]
    rows = about.select("key", "rep", "component", shard.alias("shard"), F.lit(False).alias("stray")).unionByName(
        about.where(stray).select(
            "key", "rep", "component", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(True).alias("stray")
        )
    )
    rows = rows.select(*columns).join(classes.select("rep", "signature", "sketch", "n_shingles"), "rep")
    dealt = rows.repartition("key", "shard").sortWithinPartitions("key", "shard")

    def compared(group: pa.Table, key: int) -> Iterator[tuple]:
        rep, component = group["rep"].to_numpy(), group["component"].to_numpy()
        size, is_stray = group["n_shingles"].to_numpy(), group["stray"].to_numpy(zero_copy_only=False)
        signature = _matrix(group["signature"].combine_chunks())
        subs = _subkeys(signature)
        sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(-1, BINS)
        here = np.array([key], np.int64).view(np.uint64)[0]
        own = np.flatnonzero(~is_stray)
        also_stray = np.isin(rep[own], rep[is_stray])
        for s in np.flatnonzero(is_stray):
            # Of two strays the smaller one asks; others are asked by the stray.
            ask = own[(component[own] != component[s]) & (~also_stray | (rep[own] > rep[s]))]
            # A pair is told by the first bucket that it shares.
            same = subs[ask] == subs[s]
            first_a, first_b = same[:, :SUBKEYS].argmax(axis=1), same[:, SUBKEYS:].argmax(axis=1)
            ask = ask[_table_key(subs[s][first_a], subs[s][SUBKEYS + first_b]) == here]
            ask = ask[_plausible(np.full(len(ask), size[s]), size[ask], np.broadcast_to(sketch[s], (len(ask), BINS)), sketch[ask], share)]
            if len(ask):
                yield rep[s], rep[ask]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            key, part = rows["key"].to_numpy(), rows["shard"].to_numpy()
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))
            for a, b in zip(new, [*new[1:], len(key)]):
                if b - a < 2:
                    continue
                for own, others in compared(rows.slice(a, b - a), key[a]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(own, others)), pa.array(np.maximum(own, others))], names=["l", "r"]
                    )

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) < 50_000:
                continue
            rows = pa.Table.from_batches(held)
            key, part = rows["key"].to_numpy(), rows["shard"].to_numpy()
            last = int(np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))[-1])
            if last:
                yield from flush(rows.slice(0, last))
                held = rows.slice(last).combine_chunks().to_batches()
        if held:
            yield from flush(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "l long, r long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """rep, component (its smallest member) of every node of the edges (l, r), by alternating large and small stars.

    Each round is written to the shared folder; the last one stays there as the result.
    """

    def stars(pairs: DataFrame, large: bool) -> DataFrame:
        # Every node's smallest neighbour (itself included) takes the larger ones, or those not larger.
        both = pairs.unionByName(pairs.select(F.col("r").alias("l"), F.col("l").alias("r")))
        smallest = both.groupBy("l").agg(F.least(F.min("r"), F.first("l")).alias("m"))
        if large:
            moved = both.where("r > l").join(smallest, "l").select(F.col("r").alias("l"), F.col("m").alias("r"))
        else:
            down = both.where("r < l")
            moved = down.join(smallest, "l").select(F.col("r").alias("l"), F.col("m").alias("r")).unionByName(
                smallest.select("l", F.col("m").alias("r"))
            )
        return moved.where("l <> r").select(F.greatest("l", "r").alias("l"), F.least("l", "r").alias("r")).distinct()

    with Workbench(edges.sparkSession) as bench:
        now = bench.written(edges.where("l <> r").select(F.greatest("l", "r").alias("l"), F.least("l", "r").alias("r")).distinct())
        told = None
        while True:
            now = bench.written(stars(stars(now, True), False))
            state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("l", "r").cast("decimal(38,0)"))).first()
            if state == told:
                break
            told = state
        roots = now.select(F.col("r").alias("rep"), F.col("r").alias("component")).distinct()
        return written(now.select(F.col("l").alias("rep"), F.col("r").alias("component")).unionByName(roots))


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id that links reach.

    Signatures, buckets and sets are removed when the components are known; the result reads two narrow tables.
    """
    with Workbench(docs.sparkSession) as bench:
        rows = bench.written(signed(docs, doc_id, text))
        full = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
        classes = bench.written(
            full.groupBy("digest").agg(
                F.min("doc_id").alias("rep"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"),
                F.first("n_shingles").alias("n_shingles"),
            )
        )
        buckets = bench.written(table_keys(classes))
        smallest = buckets.groupBy("key").agg(F.min("rep").alias("r"))
        star = buckets.join(smallest, "key").where("rep <> r").select(F.col("rep").alias("l"), "r").distinct()
        met = buckets.select(F.col("rep").alias("doc_id")).distinct()
        sets = bench.written(shingles_of(docs, met, doc_id, text).where(F.length("shingles") > 0).distinct())
        links = verified(star, sets, share)
        # Documents with several texts join their classes.
        several = full.select("doc_id", "digest").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
        own = (
            full.join(several, "doc_id").join(classes.select("digest", "rep"), "digest")
            .where("doc_id <> rep").select(F.col("doc_id").alias("l"), F.col("rep").alias("r"))
        )
        first = components(links.unionByName(own))
        strays = bench.written(stray_pairs(buckets, classes, first, share))
        more = verified(strays, sets, share)
        placed = first.where("rep <> component").select(F.col("rep").alias("l"), F.col("component").alias("r"))
        final = components(placed.unionByName(more))
        member = written(
            classes.join(final, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
        )
        narrow = written(rows.select("doc_id", "n_shingles", "digest"))
    known = narrow.where("doc_id IS NOT NULL").join(member, "digest", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).alias("component")
    )
    return known.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).unionByName(
        narrow.where("doc_id IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    )
