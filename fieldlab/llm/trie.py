"""Conversation prefix trie with subtree totals by time-forward processing.

Conversations share prefixes of turns; every distinct sequence of first d turns is a node, the empty one the root. A node's key is
128 bits: the exclusive-or of the hashes of (place, digest of role and text) of its turns, made by one ordered scan, so a
conversation of any length spreads over as many tasks as it needs.

*Totals* (children, leaves, saved words) go from the leaves to the root:

* A node of one conversation is a link of that conversation's own end; its totals are known. The top of such an end sends
  one leaf to its parent.
* *Shards.* A node is heavy if more than 1 / (4 * partitions) of all conversations pass it, and the root is; heavy nodes are a top
  part of the tree, at most 4 * partitions of them at each depth. The subtrees that hang below them are the shards; none has
  more conversations than that share.
* *Time-forward processing* in shards: the nodes of a task's shards are sorted (by Spark, on disk where needed) in reverse level order. A
  priority queue holds the totals sent to nodes that come later; when a node comes, its messages are at the queue's head; it adds
  them up and sends the sum to its parent. Beyond ``QUEUE`` messages the queue spills sorted runs and merges them when they are
  read. A shard's root sends to its heavy parent instead, summed up per parent by Spark.
* *Across shard roots* the heavy nodes go through the same step, in one task.

Spilled runs are unlinked files in Spark's own local directories: nobody but the task reads them, and they end with it.

Turns are ordered by ``turn`` (null first), ties by the digest of role and text. Null role or text is empty. Rows without conv_id belong to
no conversation. Repeated rows are turns of their own. Very long texts enter as digest and word count only. A digest of ending
members is streamed in order of conv_id, whatever their number. An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlab.llm.frames import batch_of, shuffle_partitions
from fieldlab.operators.skew import numbered, running
from fieldlab.session import Workbench, written

#: Messages that a queue holds in memory; a message is six numbers.
QUEUE = 200_000
#: Rows of a run that are read at once.
_READ = 4096
KEY, PARENT = ["k1", "k2"], ["p1", "p2"]


class SpillingQueue:
    """A priority queue of rows of whole numbers, smallest first, that spills sorted runs beyond ``most`` rows."""

    def __init__(self, width: int, most: int = QUEUE):
        self.width, self.most = width, most
        self.heap: list[tuple[int, ...]] = []
        self.heads: list[tuple[tuple[int, ...], int]] = []
        self.runs: list[Iterator[tuple[int, ...]]] = []

    def push(self, row: tuple[int, ...]) -> None:
        heappush(self.heap, row)
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        run = tempfile.TemporaryFile(dir=folder)
        np.array(sorted(self.heap), np.int64).tofile(run)
        run.seek(0)
        self.heap = []
        rows = self._read(run)
        self.runs.append(rows)
        heappush(self.heads, (next(rows), len(self.runs) - 1))

    def _read(self, run) -> Iterator[tuple[int, ...]]:
        with run:
            while len(part := np.fromfile(run, np.int64, _READ * self.width)):
                yield from map(tuple, part.reshape(-1, self.width).tolist())

    def head(self) -> tuple[int, ...] | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple[int, ...]:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            row, i = self.heads[0]
            following = next(self.runs[i], None)
            if following is None:
                heappop(self.heads)
            else:
                heapreplace(self.heads, (following, i))
            return row
        return heappop(self.heap)


TOTALS = "k1 long, k2 long, p1 long, p2 long, top boolean, n_children long, n_leaves long, saved_tokens long"


def time_forward(nodes: DataFrame) -> DataFrame:
    """Totals of nodes whose partitions are in reverse level order (depth falling, then key).

    ``nodes`` has key, parent key, depth, ``top`` (sends nothing here) and what came from elsewhere or is the node's own:
    n_children, n_leaves, saved_tokens.
    """
    most = QUEUE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(6, most)
        for batch in batches:
            if not batch.num_rows:
                continue
            made = []
            for k1, k2, p1, p2, depth, top, children, leaves, saved in zip(*(c.to_pylist() for c in batch.columns)):
                here = (-depth, k1, k2)
                while (head := queue.head()) is not None and head[:3] == here:
                    _, _, _, more, below, kept = queue.pop()
                    children, leaves, saved = children + more, leaves + below, saved + kept
                leaves = leaves if children else 1
                made.append((k1, k2, p1, p2, top, children, leaves, saved))
                if not top:
                    queue.push((1 - depth, p1, p2, 1, leaves, saved))
            names = ["k1", "k2", "p1", "p2", "top", "n_children", "n_leaves", "saved_tokens"]
            yield batch_of(**{name: pa.array(c, pa.bool_() if name == "top" else pa.int64()) for name, c in zip(names, zip(*made))})

    columns = [*KEY, *PARENT, "depth", "top", "n_children", "n_leaves", "saved_tokens"]
    return nodes.select(*columns).mapInArrow(run, TOTALS)


def rebuilt_first_turns() -> tuple[Column, Column]:
    """For a conversation: the one whose first turns it gets, and how many."""
    return F.col("conv_id") - F.col("conv_id") % 20, (F.crc32(F.col("conv_id").cast("string")) % 4).cast("long")


def digested_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, timed, turn, digest of role and text, words of the text; rows without conv_id are left out."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("timed"), "turn",
        F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"),
    )


def placed_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest and words of digested turns, in order of turn."""
    order = ["timed", "turn", "digest", "words"]
    return numbered(turns, ["conv_id"], order, "place").select("conv_id", "place", "digest", "words")


def rebuilt(placed: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), digest, words: the first h turns of conversation c - c % 20, then c's own turns after its first h."""
    base, h = rebuilt_first_turns()
    convs = placed.select("conv_id").distinct().select("conv_id", base.alias("base"), h.alias("h"))
    first = placed.where("place <= 3")
    heads = convs.join(first.withColumnRenamed("conv_id", "base"), "base").where("place <= h").select(
        "conv_id", F.col("place").alias("depth"), "digest", "words"
    )
    sizes = first.groupBy(F.col("conv_id").alias("base")).agg(F.count(F.lit(1)).alias("size"))
    own = placed.select("conv_id", "place", "digest", "words", base.alias("base"), h.alias("h")).where("place > h")
    depth = F.least("h", F.coalesce("size", F.lit(0).cast("long"))) + F.col("place") - F.col("h")
    return heads.unionByName(own.join(sizes, "base", "left").select("conv_id", depth.alias("depth"), "digest", "words"))


def members(turns: DataFrame) -> DataFrame:
    """conv_id, depth, key, parent key and words of every node that a conversation passes, without the root (key 0, 0)."""
    hashed = turns.select(
        "conv_id", "depth", "words", F.xxhash64("depth", "digest").alias("x1"), F.xxhash64(F.lit("second"), "digest", "depth").alias("x2")
    )
    keyed = running(hashed, ["conv_id"], ["depth"], {"k1": ("bit_xor", "x1"), "k2": ("bit_xor", "x2")})
    return keyed.select(
        "conv_id", "depth", "words", *KEY, F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("p2")
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """key, ends_sha256: SHA-256 of each node's ending conv_ids, ascending, comma-joined. Rows are streamed, none is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for k1, k2, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (k1, k2) == now:
                    state.update(f",{conv}".encode())
                    continue
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = (k1, k2), hashlib.sha256(str(conv).encode())
            if done:
                a, b, digest = zip(*done)
                yield batch_of(k1=pa.array(a, pa.int64()), k2=pa.array(b, pa.int64()), ends_sha256=pa.array(digest))
        if now is not None:
            yield batch_of(k1=pa.array([now[0]], pa.int64()), k2=pa.array([now[1]], pa.int64()), ends_sha256=pa.array([state.hexdigest()]))

    dealt = ends.select(*KEY, "conv_id").repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
    return dealt.mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


def _zero() -> Column:
    return F.lit(0).cast("long")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, depth, digest and words; ``convs`` names every conversation, those without turns too.
    """
    spark = turns.sparkSession
    parts = shuffle_partitions(spark)
    with Workbench(spark) as bench:
        convs = bench.written(convs.select("conv_id").distinct())
        passed = bench.written(members(turns))
        top = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
            _zero().alias("k1"), _zero().alias("k2"), _zero().alias("depth"), "conv_id", "n_convs", _zero().alias("words"),
            F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"),
        )
        nodes = bench.written(
            passed.groupBy(*KEY).agg(
                F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"),
                F.min("p1").alias("p1"), F.min("p2").alias("p2"),
            ).unionByName(top)
        )
        whole = nodes.where("depth = 0").select("n_convs").scalar()
        heavy_from = F.greatest(F.lit(1), F.floor(whole / (4 * parts)))
        heavy = (F.col("depth") == 0) | (F.col("n_convs") > heavy_from)
        shared = nodes.where("n_convs > 1 OR depth = 0")
        # Ends of single conversations: the top one sends a leaf to its parent.
        single = nodes.where("n_convs = 1 AND depth > 0")
        sent = single.groupBy("conv_id").agg(F.min_by(F.struct(*PARENT), "depth").alias("p")).groupBy(
            F.col("p.p1").alias("k1"), F.col("p.p2").alias("k2")
        ).agg(F.count(F.lit(1)).alias("c1"))
        given = shared.join(sent, KEY, "left").select(
            *KEY, *PARENT, "depth", "conv_id", "n_convs", heavy.alias("heavy"), F.coalesce("c1", _zero()).alias("n_children"),
            F.coalesce("c1", _zero()).alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        )
        given = bench.written(given)
        # A conversation's shard is the first node on its path that is not heavy.
        marked = passed.join(given.where("heavy").select(*KEY, "heavy"), KEY, "left").where("heavy IS NULL")
        roots = marked.groupBy("conv_id").agg(F.min_by(F.struct(F.col("k1").alias("r1"), F.col("k2").alias("r2")), "depth").alias("r")).select("conv_id", "r.*")
        light = given.where("NOT heavy").join(roots, "conv_id")
        in_shards = light.withColumn("top", (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2"))).repartition(parts, "r1", "r2")
        below = bench.written(time_forward(in_shards.sortWithinPartitions(F.desc("depth"), *KEY)))
        arrived = below.where("top").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
            F.count(F.lit(1)).alias("c2"), F.sum("n_leaves").alias("l2"), F.sum("saved_tokens").alias("s2")
        )
        added = {
            name: F.col(name) + F.coalesce(more, _zero()) for name, more in (("n_children", "c2"), ("n_leaves", "l2"), ("saved_tokens", "s2"))
        }
        across = given.where("heavy").join(arrived, KEY, "left").withColumns(added).withColumn("top", F.col("depth") == 0)
        above = time_forward(across.repartition(1).sortWithinPartitions(F.desc("depth"), *KEY))
        sizes = passed.groupBy("conv_id").agg(F.max("depth").alias("n_turns"), F.max_by(F.struct(*KEY), "depth").alias("at"))
        own_ends = single.join(sizes.select("conv_id", "n_turns"), "conv_id").select(
            *KEY, (F.col("depth") < F.col("n_turns")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), _zero().alias("saved_tokens")
        )
        told = [*KEY, "n_children", "n_leaves", "saved_tokens"]
        totals = below.select(*told).unionByName(above.select(*told)).unionByName(own_ends)
        ends = convs.join(sizes, "conv_id", "left").select(
            "conv_id", F.coalesce("at.k1", _zero()).alias("k1"), F.coalesce("at.k2", _zero()).alias("k2")
        )
        parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
        none = hashlib.sha256(b"").hexdigest()
        return written(
            nodes.select(*KEY, *PARENT, "depth", "conv_id", "n_convs").join(parents, PARENT, "left").join(totals, KEY).join(end_digests(ends), KEY, "left")
            .select(
                "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
            )
        )


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    with Workbench(conversations.sparkSession) as bench:
        # Texts are read once; the ordered scan goes over their digests.
        placed = bench.written(placed_turns(bench.written(digested_turns(conversations))))
        return trie(rebuilt(placed), placed.select("conv_id"))
