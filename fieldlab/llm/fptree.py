"""Ranked lexical search by a document FP-tree with branch and bound.

Terms are runs of ASCII letters and digits and of anything beyond ASCII, A-Z in lower case. Items are bag-of-terms queries; only
terms of some item matter, so a document is reduced to its *restricted vector*: the item terms in it with their counts.

1. *Statistics.* One scan makes the restricted vectors and writes them, a fraction of the texts' size, to the shared folder. From these
   come N (documents with a term), L (all terms) and df of every item term, by partial sums.
2. *Tree.* A task packs its vectors into blocks of ``BLOCK`` postings. In a block, vectors list their terms from the most frequent term
   to the rarest and are sorted, so vectors with a common beginning share a trie path. A node is a run of sorted vectors; it
   keeps the largest tf of its term and the smallest m of its run, where m is a document's length norm.
3. *Search.* An item's terms pick their nodes; nested runs make the tree restricted to the item, in which a document's path is
   exactly its item terms. A node's gain is the most its term can give with its tf maximum and m minimum. From the leaves up,
   every node gets the best sum of gains below it. Depth first, the best child first, a subtree whose bound is under the
   tenth score so far is left out; documents that end at a visited node are scored exactly.
4. *Merge.* Each task tells ten rows per item at most; the first ten of all are taken with a rank limit on the map side.

Items go to the tasks in blocks of ``ITEMS``; each block of items is a pass over the written vectors of its own terms.

The score of a document sums, over the item's distinct terms, w * ((1000000000 * tf) div (1000 * tf + 8 * m)) with
w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))) and m = 10 + ((90 * n * N) div L).

Null and empty texts have no terms and are never found; items without terms have no rows. Equal scores go by ascending doc_id, null
last. Rows are documents and items of their own, repeated ones too. Very long texts are counted whole, in slices of a batch.
An empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlab.llm import kernels as K
from fieldlab.llm.frames import arrow_map, bytes_of, slices
from fieldlab.operators.skew import numbered
from fieldlab.session import Workbench, written

#: Documents told per item.
TOP = 10
#: Items that are sent to the tasks at once; more items are searched in several passes.
ITEMS = 5_000
#: Postings of a tree; a longer vector is a tree of its own.
BLOCK = 2_000_000

_TERM = np.zeros(256, bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def term_runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each term, and for each text the index of its first term (``len(at)`` entries)."""
    full = _TERM[data]
    first = np.zeros(len(data) + 1, bool)
    first[at] = True
    before = np.zeros(len(data), bool)
    before[1:] = full[:-1]
    begin = np.flatnonzero(full & (~before | first[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = full[1:]
    end = np.flatnonzero(full & (~after | first[1:])) + 1
    return begin, end, np.searchsorted(begin, at)


def terms_of(text: str | None) -> list[str]:
    """Distinct terms of one text in ascending order of their bytes."""
    data = K.lowered(np.frombuffer((text or "").encode(), np.uint8))
    begin, end, _ = term_runs(data, np.array([0, len(data)]))
    return [t.decode() for t in sorted({data[a:b].tobytes() for a, b in zip(begin, end)})]


class Vocabulary:
    """Item terms by number; finds the terms of a buffer, hash first, then byte by byte."""

    def __init__(self, terms: list[bytes]):
        self.raw = np.frombuffer(b"".join(terms), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64)
        hashes = K.Prefix(self.raw).of(self.at[:-1], self.at[1:])
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.lengths = np.diff(self.at)

    def find(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each run's term, -1 for one that no item has."""
        found = np.full(len(begin), -1, np.int64)
        if not len(self.hashes) or not len(begin):
            return found
        own = K.Prefix(data).of(begin, end)
        lo = np.searchsorted(self.hashes, own)
        todo = np.flatnonzero(lo < len(self.hashes))
        step = 0
        while len(todo):  # terms of one hash follow each other
            place = lo[todo] + step
            inside = place < len(self.hashes)
            todo, place = todo[inside], place[inside]
            same = self.hashes[place] == own[todo]
            todo, term = todo[same], self.order[place[same]]
            fits = np.flatnonzero((end[todo] - begin[todo] == self.lengths[term]) & (found[todo] < 0))
            length = self.lengths[term[fits]]
            left, right = K.ranges(begin[todo[fits]], length), K.ranges(self.at[term[fits]], length)
            differ = np.add.reduceat((data[left] != self.raw[right]).astype(np.int64), np.cumsum(length) - length) if len(length) else length
            found[todo[fits[differ == 0]]] = term[fits[differ == 0]]
            todo = todo[found[todo] < 0]
            step += 1
        return found


VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"


def restricted(docs: DataFrame, terms: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (all terms, repeats too), and the numbers of the given terms in the text with their counts."""
    raw = [t.encode() for t in terms]
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kept: list[Vocabulary] = []

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not kept:
            kept.append(Vocabulary(raw))
        data, at = bytes_of(batch.column("text"))
        for a, b in slices(at):
            part, places = K.lowered(data[at[a] : at[b]]), at[a : b + 1] - at[a]
            begin, end, first = term_runs(part, places)
            term = kept[0].find(part, begin, end)
            owner = np.repeat(np.arange(b - a), np.diff(first))[term >= 0]
            pair, tf = np.unique(owner * np.int64(max(1, len(raw))) + term[term >= 0], return_counts=True)
            owner, term = np.divmod(pair, max(1, len(raw)))
            offsets = pa.array(np.searchsorted(owner, np.arange(b - a + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, b - a).cast(pa.int64()), pa.array(np.diff(first)),
                    pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.minimum(tf, 2**31 - 1).astype(np.int32))),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return arrow_map(narrow, run, VECTORS)


class Tree:
    """The FP-tree of a block of restricted vectors; ``rank`` numbers terms from the most frequent one."""

    def __init__(self, ids: np.ndarray, start: np.ndarray, rank: np.ndarray, tf: np.ndarray, m: np.ndarray):
        size = np.diff(start)
        owner = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((rank, owner))
        rank, tf = rank[order], tf[order]
        keys = rank.astype(">u4")
        paths = [keys[a:b].tobytes() for a, b in zip(start[:-1], start[1:])]
        self.docs = np.array(sorted(range(len(paths)), key=lambda i: (paths[i], m[i])), np.int64)
        self.ids, self.m = ids[self.docs], m[self.docs]
        size = size[self.docs]
        take = K.ranges(start[:-1][self.docs], size)
        self.start = np.concatenate([[0], np.cumsum(size)])
        self.rank, self.tf = rank[take], tf[take]
        # How many first terms a vector shares with the one before it.
        depth = np.arange(len(take)) - np.repeat(self.start[:-1], size)
        owner = np.repeat(np.arange(len(size)), size)
        before = np.maximum(owner - 1, 0)
        mate = self.start[before] + depth
        known = (owner > 0) & (depth < size[before])
        same = np.zeros(len(take), bool)
        same[known] = self.rank[mate[known]] == self.rank[known]
        broken = np.flatnonzero(~same)
        shared = size.copy()
        np.minimum.at(shared, owner[broken], depth[broken])
        # A node begins where a vector leaves the path of the one before it, and is the run of vectors that keep its path.
        new = depth >= np.repeat(shared, size)
        self.node = np.flatnonzero(new)
        number = np.full(len(take), -1, np.int64)
        number[self.node] = np.arange(len(self.node))
        self.node_of = self._inherited(number, depth, owner, new)
        self.label = self.rank[self.node]
        self.first = owner[self.node]
        self.last = self.first.copy()
        np.maximum.at(self.last, self.node_of, owner)
        self.most = np.zeros(len(self.node), np.int64)
        np.maximum.at(self.most, self.node_of, self.tf)
        self.least = np.full(len(self.node), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.node_of, self.m[owner])
        at_top = depth[self.node] == 0
        self.parent = np.where(at_top, -1, self.node_of[np.maximum(self.node - 1, 0)])
        by_label = np.argsort(self.label, kind="stable")
        self.by_label, self.labels = by_label, self.label[by_label]

    def _inherited(self, number: np.ndarray, depth: np.ndarray, owner: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Node of every posting: the latest node made at its depth."""
        order = np.lexsort((owner, depth))
        latest = np.maximum.accumulate(np.where(number[order] >= 0, np.arange(len(order)), 0))
        made = np.empty(len(order), np.int64)
        made[order] = number[order][latest]
        return made

    def nodes_of(self, rank: int) -> np.ndarray:
        return self.by_label[np.searchsorted(self.labels, rank) : np.searchsorted(self.labels, rank, "right")]


def gains(w: np.ndarray | int, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term gives to the score; it grows with tf and falls with m."""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def search(tree: Tree, ranks: list[int], weights: list[int], top: list[tuple[int, int]], most: int = TOP) -> int:
    """Put the block's best documents for one item into the heap ``top`` of (score, -doc_id); returns the nodes visited."""
    parts = [tree.nodes_of(r) for r in ranks]
    nodes = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    if not len(nodes):
        return 0
    w = np.repeat(np.array(weights, np.int64), [len(p) for p in parts])
    gain = gains(w, tree.most[nodes], tree.least[nodes])
    # Preorder of runs; the parent is the nearest node above that has a term of the item.
    order = np.lexsort((tree.node[nodes], tree.first[nodes]))
    nodes, gain, w = nodes[order], gain[order], w[order]
    place = np.full(len(tree.node), -1, np.int64)
    place[nodes] = np.arange(len(nodes))
    up = tree.parent[nodes]
    climbing = np.flatnonzero((up >= 0) & (place[up] < 0))
    while len(climbing):
        up[climbing] = tree.parent[up[climbing]]
        climbing = climbing[(up[climbing] >= 0) & (place[np.maximum(up[climbing], 0)] < 0)]
    parent = np.where(up >= 0, place[np.maximum(up, 0)], -1)
    level = np.zeros(len(nodes), np.int64)
    below_root = np.flatnonzero(parent >= 0)
    levels, here = [np.flatnonzero(parent < 0)], np.zeros(len(nodes), bool)
    while len(below_root):
        here[:] = False
        here[levels[-1]] = True
        step = here[parent[below_root]]
        level[below_root[step]] = len(levels)
        levels.append(below_root[step])
        below_root = below_root[~step]
    # The best sum of gains on a path below each node, from the deepest level up.
    below = np.zeros(len(nodes), np.int64)
    for at in reversed(levels[1:]):
        np.maximum.at(below, parent[at], gain[at] + below[at])
    bound = gain + below
    by_parent = np.lexsort((-bound, parent))
    heads = np.searchsorted(parent[by_parent], np.arange(-1, len(nodes) + 1))
    first, last = tree.first[nodes], tree.last[nodes]
    weight_of = dict(zip(ranks, weights))

    def score(doc: int) -> int:
        a, b = tree.start[doc], tree.start[doc + 1]
        total, m = 0, 8 * int(tree.m[doc])
        for r, tf in zip(tree.rank[a:b].tolist(), tree.tf[a:b].tolist()):
            if (own := weight_of.get(r)) is not None:
                total += own * ((1_000_000_000 * tf) // (1000 * tf + m))
        return total

    visited, stack = 0, [(-1, 0)]
    while stack:
        v, path = stack.pop()
        if v >= 0 and len(top) == most and path + below[v] < top[0][0]:
            continue
        visited += 1
        children = by_parent[heads[v + 1] : heads[v + 2]]
        if v >= 0 and (len(top) < most or path >= top[0][0]):
            # Documents of the run that no child has end here.
            own = np.ones(last[v] - first[v] + 1, bool)
            for c in children:
                own[first[c] - first[v] : last[c] - first[v] + 1] = False
            for doc in (np.flatnonzero(own) + first[v]).tolist():
                found = (score(doc), -int(tree.ids[doc]))
                if found[0] > 0 and len(top) < most:
                    heappush(top, found)
                elif found[0] > 0 and found > top[0]:
                    heapreplace(top, found)
        least = top[0][0] if len(top) == most else 0
        # The best child is on top of the stack.
        stack += [(int(c), path + int(gain[c])) for c in children[::-1] if path + bound[c] >= least]
    return visited


#: A null doc_id sorts behind all others.
_LAST = 2**63 - 1


def _searched(vectors: DataFrame, items: list[tuple[int, list[int], list[int]]], rank: np.ndarray, documents: int, length: int) -> DataFrame:
    """item, doc_id, score: the best documents of each task. ``rank`` orders the terms by falling frequency."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        held: list[tuple] = []

        def build() -> None:
            ids, n, size, term, tf = (np.concatenate(x) for x in zip(*held))
            held.clear()
            m = np.array([10 + 90 * k * documents // length for k in n.tolist()], np.int64)
            tree = Tree(ids, np.concatenate([[0], np.cumsum(size)]), rank[term], tf.astype(np.int64), m)
            for top, (_, ranks, weights) in zip(best, items):
                search(tree, ranks, weights, top)

        for batch in batches:
            lists = batch.column("terms")
            size = np.diff(lists.offsets.to_numpy())
            full = size > 0
            ids = batch.column("doc_id").fill_null(_LAST).to_numpy()
            held.append((ids[full], batch.column("n").to_numpy()[full], size[full], lists.flatten().to_numpy(), batch.column("tfs").flatten().to_numpy()))
            if sum(len(x[3]) for x in held) >= BLOCK:
                build()
        if sum(len(x[3]) for x in held):
            build()
        rows = [(item, -doc, score) for top, (item, _, _) in zip(best, items) for score, doc in top]
        if rows:
            item, doc, score = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int64()), pa.array([None if d == _LAST else d for d in doc], pa.int64()), pa.array(score, pa.int64())], names=["item", "doc_id", "score"]
            )

    wanted = vectors.where(F.size("terms") > 0).select("doc_id", "n", "terms", "tfs")
    return wanted.mapInArrow(run, "item long, doc_id long, score long")


def ranked_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the best ``TOP`` documents of every item with a score above 0."""
    spark = docs.sparkSession
    narrow = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    listed = narrow.withColumn("_row", F.xxhash64("text"))
    queries = written(numbered(listed, [], ["item_id", "_row", "text"], "item").select("item", "item_id", "text"))
    n_items = queries.count()
    found = []
    with Workbench(spark) as bench:
        for low in range(0, n_items, ITEMS):
            block = [(r["item"], terms_of(r["text"])) for r in queries.where(F.col("item").between(low + 1, low + ITEMS)).select("item", "text").collect()]
            terms = sorted({t for _, own in block for t in own})
            if not terms:
                continue
            vectors = bench.written(restricted(docs, terms, doc_id, text))
            total = vectors.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("length")).first()
            if not total["documents"]:
                continue
            df = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("k")).collect())
            held = np.array([df.get(i, 0) for i in range(len(terms))], np.int64)
            rank = np.empty(len(terms), np.int64)
            rank[np.lexsort((np.arange(len(terms)), -held))] = np.arange(len(terms))
            number = {t: i for i, t in enumerate(terms)}
            documents, length = total["documents"], total["length"]
            weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * k + 1))) for k in held.tolist()]
            sent = []
            for item, own in block:
                numbers = [number[t] for t in own if held[number[t]]]
                sent.append((item, [int(rank[i]) for i in numbers], [weight[i] for i in numbers]))
            found.append(written(_searched(vectors, [x for x in sent if x[1]], rank, documents, length)))
    if not found:
        return queries.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return best.join(queries.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
