"""Exact substring dedup by sorted suffixes: bytes covered by a ``LENGTH``-byte string that also starts earlier are removed.

1. *Anchors.* Every window of ``LENGTH`` bytes picks one of its k-grams, the leftmost with the smallest hash. The pick
   depends on the window's bytes alone, so equal windows pick at the same place, and two windows can only be equal if they
   belong to anchors of equal k-grams. About one byte in 32 is an anchor.
2. *Alike anchors.* Anchors are range-partitioned by k-gram hash, stretch hash and place, so that even the most frequent
   one is spread over tasks. The stretch is all that the anchor's windows cover. An anchor whose k-gram and stretch (together
   128 bits) occur earlier has only windows that occur earlier. The first of each stretch goes on if its k-gram has other
   stretches too.
3. *Suffixes.* The bytes of these stretches are range-partitioned by the anchor's leading tokens and place; Spark samples
   the splitters. Each bucket sorts its windows by multikey quicksort and marks all but the first of equal ones. Buckets hold
   consecutive ranges, so only windows of a bucket's first and last k-gram can have equals in other buckets: those are compared
   across the boundaries by their digests.
4. Marked windows are joined to byte runs per document and cut out.

Documents are in order of doc_id (null first), rows of one doc_id with different texts in the order of the text's key; rows that
repeat both are one document and get equal results. Null texts are empty. Texts shorter than ``LENGTH`` lose nothing. An empty table gives
an empty table. Other columns are ignored. Long texts are worked on in pieces that overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlab.llm import kernels as K
from fieldlab.llm.frames import arrow_map, bytes_of, gathered, keyed_texts, shuffle_partitions, slices
from fieldlab.session import written

LENGTH = 100
#: Bytes of an anchor's k-gram; windows then have WINDOW k-grams to pick from.
GRAM = 37
WINDOW = LENGTH - GRAM + 1
#: Longest piece of a text worked on at once.
PIECE = 1 << 19

ANCHORS = "doc_id long, n int, pos long, gram long, stretch long"


def anchors_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of the texts of a buffer: text, place, first and last window start, hash of the k-gram and of the stretch."""
    size = len(data)
    if size < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),) * 2
    prefix = K.Prefix(data)
    starts = np.arange(size - GRAM + 1)
    gram = prefix.of(starts, starts + GRAM)
    pick = K.sliding_argmin(gram, WINDOW)
    lengths = np.diff(at)
    last = at[1:] - LENGTH
    # Window starts that lie with all their bytes in one text.
    fits = np.maximum(0, last - at[:-1] + 1)
    window = K.ranges(at[:-1], fits)
    text = np.repeat(np.arange(len(lengths)), fits)
    if not len(window):
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),) * 2
    place = pick[window]
    head = np.ones(len(window), bool)
    head[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(head)
    final = np.concatenate([first[1:], [len(window)]]) - 1
    where, lo, hi = place[first], window[first], window[final]
    stretch = K.Prefix(data, K.BASES[1]).of(lo, hi + LENGTH)
    stretch = K.mixed(stretch + ((where - lo).astype(np.uint64) << np.uint64(8)) + (hi - where + WINDOW).astype(np.uint64))
    return text[first], where, lo, hi, gram[where], stretch


def packed(place: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Place in the text and the distances to the first and last window start, in one number that sorts by place."""
    return (place << 14) | ((place - lo) << 7) | (place - hi)


def unpacked(pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    place = pos >> 14
    return place, place - ((pos >> 7) & 127), place - (pos & 127)


def pieces(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of a batch: bytes, limits, and for each limit's text its number and where the part begins in it."""
    for a, b in slices(at, PIECE):
        begin, end = at[a], at[b]
        if b - a > 1 or end - begin <= 2 * PIECE:
            yield data[begin:end], at[a : b + 1] - begin, np.arange(a, b), np.zeros(b - a, np.int64)
            continue
        for cut in range(0, int(end - begin) - LENGTH + 1, PIECE):
            part = data[begin + cut : min(end, begin + cut + PIECE + LENGTH - 1)]
            yield part, np.array([0, len(part)]), np.array([a]), np.array([cut])


def anchors(docs: DataFrame) -> DataFrame:
    """Anchors of keyed texts."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, keys = batch.column("doc_id"), batch.column("n")
        data, at = bytes_of(batch.column("text"))
        for part, limits, number, shift in pieces(data, at):
            text, where, lo, hi, gram, stretch = anchors_of(part, limits)
            base = limits[text] - shift[text]
            pos = packed(where - base, lo - base, hi - base)
            take = pa.array(number[text])
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), keys.take(take), pa.array(pos), pa.array(gram.view(np.int64)), pa.array(stretch.view(np.int64))],
                names=["doc_id", "n", "pos", "gram", "stretch"],
            )

    return arrow_map(docs, run, ANCHORS)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before; true for the first."""
    new = np.ones(len(columns[0]), bool)
    if len(new) > 1:
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def _long(column: pa.Array) -> np.ndarray:
    """A long column as numbers; null is below all others (for comparing only)."""
    import pyarrow.compute as pc

    return pc.fill_null(column, np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def alike(found: DataFrame) -> DataFrame:
    """Anchors that matter: ``seen`` ones, whose stretch occurs earlier, and the others of k-grams that have several stretches.

    Rows come sorted by gram, stretch, doc_id, n, pos and cut at any row. A bucket takes the first row it sees of a stretch as
    that stretch's first; if an earlier bucket has it too, the row goes on to the suffixes, which decide exactly. For the same
    reason the first and last k-gram of a bucket always go on.
    """
    order = ["gram", "stretch", "doc_id", "n", "pos"]
    dealt = found.repartitionByRange(shuffle_partitions(found.sparkSession), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        opened = True

        def judged(rows: pa.Table, edge: bool) -> pa.RecordBatch | None:
            """Rows of whole k-grams; edge: their first k-gram is the bucket's first, or their last the bucket's last."""
            gram, stretch = (rows[c].to_numpy() for c in ("gram", "stretch"))
            ids, n = _long(rows["doc_id"].combine_chunks()), rows["n"].to_numpy()
            place = rows["pos"].to_numpy() >> 14
            new_gram = _changes(gram)
            new_stretch = new_gram | _changes(stretch)
            leader = np.maximum.accumulate(np.where(new_stretch, np.arange(len(gram)), 0))
            # Pieces of a long text may give one anchor twice; that is no earlier occurrence.
            own = (ids == ids[leader]) & (n == n[leader]) & (place == place[leader])
            group = np.cumsum(new_gram) - 1
            several = np.bincount(group, new_stretch) > 1
            if edge:
                several[0] = several[-1] = True
            seen = ~new_stretch & ~own
            keep = seen | several[group] | (own & ~new_stretch)
            if not keep.any():
                return None
            take = pa.array(np.flatnonzero(keep))
            out = rows.take(take).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [out[c].combine_chunks() for c in ("doc_id", "n", "pos", "gram")] + [pa.array(seen[keep])],
                names=["doc_id", "n", "pos", "gram", "seen"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < 100_000:
                continue
            rows = pa.Table.from_batches(held)
            gram = rows["gram"].to_numpy()
            last = int(np.flatnonzero(_changes(gram))[-1])
            if last == 0:
                continue  # one k-gram so far
            made = judged(rows.slice(0, last), opened)
            opened = False
            if made:
                yield made
            held = rows.slice(last).combine_chunks().to_batches()
        if held:
            made = judged(pa.Table.from_batches(held), True)
            if made:
                yield made

    return dealt.mapInArrow(run, "doc_id long, n int, pos long, gram long, seen boolean")


def stretches(keyed: DataFrame, rows: DataFrame) -> DataFrame:
    """The bytes around anchors that go on: ``lead`` is what follows the anchor, ``back`` what precedes it, for its windows."""
    wanted = rows.groupBy("doc_id", "n").agg(F.sort_array(F.collect_set("pos")).alias("places"))
    joined = _by_document(keyed, wanted, "inner").select("doc_id", "n", "text", "places")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, at = bytes_of(batch.column("text"))
        places = batch.column("places")
        count = np.diff(places.offsets.to_numpy())
        pos = places.flatten().to_numpy()
        owner = np.repeat(np.arange(batch.num_rows), count)
        raw = data.tobytes()
        for a in range(0, len(pos), 20_000):
            place, lo, hi = unpacked(pos[a : a + 20_000])
            base = at[owner[a : a + 20_000]]
            take = pa.array(owner[a : a + 20_000])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(take), batch.column("n").take(take), pa.array(pos[a : a + 20_000]),
                    pa.array([raw[x:y] for x, y in zip(base + place, base + hi + LENGTH)], pa.binary()),
                    pa.array([raw[x:y] for x, y in zip(base + lo, base + place)], pa.binary()),
                ],
                names=["doc_id", "n", "pos", "lead", "back"],
            )

    return arrow_map(joined, run, "doc_id long, n int, pos long, lead binary, back binary")


def _matrix(column: pa.Array, width: int, right: bool) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows of a matrix, aligned to its left or right edge, and their lengths."""
    values = column.to_pylist()
    size = np.array([len(v) for v in values], np.int64)
    filled = b"".join(v.rjust(width, b"\0") if right else v.ljust(width, b"\0") for v in values)
    return np.frombuffer(filled, np.uint8).reshape(len(values), width), size


def sorted_suffixes(rows: DataFrame) -> DataFrame:
    """Window starts of the stretches that equal an earlier window: ``start`` to ``stop`` of each, decided or ``open``.

    Open rows are a bucket's first of its windows of its first and last k-gram; ``g1, g2`` is the window's digest.
    """
    dealt = rows.repartitionByRange(
        shuffle_partitions(rows.sparkSession), F.substring("lead", 1, GRAM), "doc_id", "n", "pos"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = gathered(batches)
        if rows is None:
            return
        ids, n, pos = _long(rows["doc_id"].combine_chunks()), rows["n"].to_numpy(), rows["pos"].to_numpy()
        lead, lead_size = _matrix(rows["lead"].combine_chunks(), LENGTH, False)
        back, back_size = _matrix(rows["back"].combine_chunks(), WINDOW, True)
        whole = np.concatenate([back, lead], axis=1)
        place, _, hi = unpacked(pos)
        far = place - hi  # the last window starts this far before the anchor
        tokens = K.row_words(lead[:, :GRAM])
        by_place = np.lexsort((pos, n, ids))
        order = by_place[K.multikey_order(tokens[by_place])]
        edge = np.zeros(len(ids), bool)
        for side in (order[0], order[-1]):
            edge |= (tokens == tokens[side]).all(axis=1)
        for back_by in range(WINDOW):
            mine = by_place[(back_size[by_place] >= back_by) & (far[by_place] <= back_by) & (lead_size[by_place] >= LENGTH - back_by)]
            if not len(mine):
                continue
            windows = whole[mine, WINDOW - back_by : WINDOW - back_by + LENGTH]
            keys = K.row_words(windows)
            ranked = K.multikey_order(keys)
            run_head = _changes(*keys[ranked].T)
            leader = ranked[np.maximum.accumulate(np.where(run_head, np.arange(len(ranked)), 0))]
            a, b = mine[ranked], mine[leader]
            again = ~run_head & ~((ids[a] == ids[b]) & (n[a] == n[b]) & (place[a] == place[b]))
            start = place[a] - back_by
            done, open_ = np.flatnonzero(again), np.flatnonzero(run_head & edge[a])
            digests = np.frombuffer(
                b"".join(hashlib.blake2b(windows[r].tobytes(), digest_size=16).digest() for r in ranked[open_]), np.int64
            ).reshape(-1, 2)
            both = np.concatenate([done, open_])
            if not len(both):
                continue
            take = pa.array(a[both])
            decided = np.arange(len(both)) < len(done)
            yield pa.RecordBatch.from_arrays(
                [
                    rows["doc_id"].combine_chunks().take(take), rows["n"].combine_chunks().take(take), pa.array(start[both]),
                    pa.array(decided),
                    # Decided rows stand alone; they are spread by their place.
                    pa.array(np.concatenate([ids[a[done]] * 31 + n[a[done]], digests[:, 0]])),
                    pa.array(np.concatenate([start[done], digests[:, 1]])),
                ],
                names=["doc_id", "n", "start", "decided", "g1", "g2"],
            )

    return dealt.mapInArrow(run, "doc_id long, n int, start long, decided boolean, g1 long, g2 long")


def across_boundaries(marked: DataFrame) -> DataFrame:
    """Decided windows, and those open ones that an earlier bucket has too. A digest has a row per bucket at most."""
    from pyspark.sql import Window

    equal = Window.partitionBy("decided", "g1", "g2").orderBy("doc_id", "n", "start")
    first = F.struct(F.col("doc_id"), F.col("n"), F.col("start"))
    ranked = marked.withColumn("_leader", F.first(first).over(equal))
    return ranked.where(F.col("decided") | (F.col("_leader") != first)).select(
        "doc_id", "n", F.col("start"), (F.col("start") + LENGTH).alias("stop")
    )


def _by_document(keyed: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Join rows per document to the texts; both joins in a plan use the same exchange of the texts."""
    other = rows.select(F.col("doc_id").alias("_id"), F.col("n").alias("_n"), *[c for c in rows.columns if c not in ("doc_id", "n")])
    return keyed.join(other.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("n") == F.col("_n")), how)


def removed_windows(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, n, start, stop of byte ranges to remove, overlapping as they come."""
    pos = F.col("pos")
    place = F.shiftright(pos, 14)
    seen = found.where("seen").select(
        "doc_id", "n",
        (place - F.shiftright(pos, 7).bitwiseAND(F.lit(127))).alias("start"),
        (place - pos.bitwiseAND(F.lit(127)) + LENGTH).alias("stop"),
    )
    return seen.unionByName(across_boundaries(sorted_suffixes(stretches(keyed, found.where("not seen")))))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, spans (removed byte runs as start, stop) and kept (the remaining bytes)."""
    keyed = keyed_texts(docs, doc_id, text)
    found = written(alike(anchors(keyed)))
    ranges = removed_windows(keyed, found).groupBy("doc_id", "n").agg(
        F.collect_list(F.struct("start", "stop")).alias("ranges")
    )
    joined = _by_document(keyed, ranges, "left").select("doc_id", "text", "ranges")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a in range(0, batch.num_rows, 128):
            part = batch.slice(a, 128)
            data, at = bytes_of(part.column("text"))
            raw = data.tobytes()
            spans, kept = [], []
            lists = part.column("ranges")
            limits = lists.offsets.to_numpy()
            pairs = lists.values
            starts, stops = (pairs.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for i in range(part.num_rows):
                own = raw[at[i] : at[i + 1]]
                lo, hi = limits[i], limits[i + 1]
                if lists.is_valid()[i].as_py() is not True or lo == hi:
                    spans.append([])
                    kept.append(own)
                    continue
                runs = merged_runs(starts[lo:hi], stops[lo:hi])
                edges = [0, *runs.ravel().tolist(), len(own)]
                spans.append([{"start": int(x), "stop": int(y)} for x, y in runs])
                kept.append(b"".join(own[x:y] for x, y in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(np.diff(at)),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    return arrow_map(joined, run, "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")


def merged_runs(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Maximal runs of ranges; ranges that touch are one run."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    head = np.ones(len(start), bool)
    head[1:] = start[1:] > stop[:-1]
    first = np.flatnonzero(head)
    return np.stack([start[first], stop[np.concatenate([first[1:], [len(start)]]) - 1]], axis=1)
