"""Fingerprints, the conversation trie and ranked search against brute force, and their corner cases."""

import hashlib
import math
import random
import re
import statistics
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import differences, duck
from conftest import SMALL
from pyspark.sql import functions as F

from fieldlab.llm import fptree, onepermutation, trie
from fieldlab.llm.queries import ORACLES, QUERIES

DOCS = "doc_id long, text string, n long, rank string, fingerprint string"


def invented(seed: int, n: int, vocabulary: int = 3000) -> str:
    chance = random.Random(seed)
    return " ".join(f"w{chance.randrange(vocabulary)}x" for _ in range(n))


# --- Fingerprints ----------------------------------------------------------------------------------------------------


def shingles(text: str) -> set:
    words = [w for w in re.split("[\x20\x09-\x0d]+", text.lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_edited_texts_and_likeness(frame):
    texts = [invented(i, n, 500) for i, n in enumerate([400, 90, 30, 7, 5, 3, 1, 2000, 300, 300])] + ["", None, "é" * 7, "word " * 20_000, "A\tb\nC d e f", "a B c D e F"]
    rows = [(3 * i - 9, t, 1, "x", "y") for i, t in enumerate(texts)]
    docs = frame(DOCS, *rows)
    made = onepermutation.edited(docs).withColumn("edited_fingerprint", onepermutation.fingerprint("edited"))
    got = {r["doc_id"]: r for r in made.withColumns({
        "near_edited": onepermutation.likeness("fingerprint", "edited_fingerprint"), "near_next": onepermutation.likeness("fingerprint", "next_fingerprint")}).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for (key, text, *_), (_, other, *_) in zip(order, [*order[1:], order[0]]):
        text, other, r = text or "", other or "", got[key]
        want = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
        assert r["text"] == text and r["edited"] == want
        for name, y in (("near_edited", want), ("near_next", other)):
            a, b = shingles(text), shingles(y)
            exact = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(r[name] - exact) < 0.16 and 0 <= r[name] <= 1, (key, name)
    by_text = {r["text"]: r["fingerprint"] for r in got.values()}
    assert by_text["A\tb\nC d e f"] == by_text["a B c D e F"] and by_text[""] == onepermutation.EMPTY
    assert len(by_text[texts[0]]) == onepermutation.BINS * onepermutation.BITS // 4


def test_likeness_is_unbiased(frame):
    chance = random.Random(4)
    rows, exact = [], {}
    for i in range(150):
        words = invented(i, chance.choice([12, 40, 150, 600])).split()
        other = list(words)
        for _ in range(chance.randrange(1, 1 + len(words) // 6)):
            other[chance.randrange(len(other))] = f"new{chance.randrange(9**9)}"
        a, b = " ".join(words), " ".join(other)
        rows.append((i, a, b))
        exact[i] = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    pairs = frame("i int, a string, b string", *rows).select("i", onepermutation.fingerprint("a").alias("a"), onepermutation.fingerprint("b").alias("b"))
    errors = [r["l"] - exact[r["i"]] for r in pairs.select("i", onepermutation.likeness("a", "b").alias("l")).collect()]
    assert abs(statistics.mean(errors)) < 0.01 and statistics.pstdev(errors) < 0.045


def test_densification_takes_the_first_full_bin(spark):
    row = spark.range(1).select(F.lit(invented(5, 40)).alias("t"))
    binned, filled = row.select(F.expr(onepermutation.binned(onepermutation.shingle_hashes("t"))), F.expr(onepermutation.densified(onepermutation.binned(onepermutation.shingle_hashes("t"))))).first()
    mark = onepermutation._MARK
    full = [x & mark != mark for x in binned]
    assert len(binned) == 256 and 20 < sum(full) < 40 and [x >> 56 for x in binned] == list(range(-128, 128))
    for j in range(256):
        places = [j] if full[j] else [(onepermutation.FIRSTS[j] + k * onepermutation.STEPS[j]) % 256 for k in range(256)]
        assert filled[j] == binned[next(i for i in places if full[i])]


def test_fingerprint_corner_cases(frame):
    same = (7, "one two three four five six", 1, "x", "y")
    docs = frame(DOCS, same, same, (None, "no id", 1, "x", "y"), (7, "other text of seven", 1, "x", "y"))
    got = onepermutation.edited(docs)
    assert got.count() == 4 and got.where("doc_id = 7").count() == 3
    last = got.where("doc_id IS NULL").first()
    assert last["edited"][:3] == "no " and last["next_fingerprint"] is not None
    assert onepermutation.edited(docs.limit(0)).count() == 0
    named = onepermutation.fingerprinted(docs)
    assert named.columns[-1] == "_fingerprint" and named.count() == 4
    one = onepermutation.edited(docs.where("doc_id IS NULL")).first()
    assert one["next_fingerprint"] == one["fingerprint"]


# --- Trie ------------------------------------------------------------------------------------------------------------


def plain_trie(rows: list[tuple]) -> set:
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, role or "", text or ""))
    given = {c: [t[2:] for t in sorted(own)] for c, own in given.items()}
    nodes, ends = defaultdict(set), defaultdict(list)
    for c, own in given.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = int(math.fmod(c, 20))
        path = tuple(given.get(c - base, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            nodes[path[:d]].add(c)
        ends[path].append(c)
    told = set()
    for path, convs in nodes.items():
        inside = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in inside if len(p) == len(path) + 1]
        leaves = [p for p in inside if not any(q[:-1] == p and q for q in inside)]
        saved = sum((len(nodes[p]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) for p in inside if p)
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest()
        told.add((min(convs), len(path), min(nodes[path[:-1]]) if path else None, len(convs), len(children), len(leaves), saved, digest))
    return told


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TALK = "conv_id long, turn int, role string, text string, depth string, k1 long"


def test_trie_against_brute_force(frame, spark):
    chance = random.Random(2)
    rows = []
    for c in [*range(0, 70), -7, -20, -21, 143]:
        for turn in range(chance.randrange(0, 7)):
            rows.append((c, turn, chance.choice(["user", "assistant", None]), chance.choice(["same words here", "same", "", None, f"own {c}", "x " * 300])))
        if c in (40, 41, 45):
            rows += [(c, t, "user", "long one") for t in range(20, 60)]
    rows += [(200, 3, "user", "b"), (200, 3, "user", "b"), (200, None, "user", "first"), (None, 1, "user", "nobody")]
    rows += [(c, t, "user", f"copy {t}") for c in range(300, 340) for t in range(4, 9)]
    talk = frame(TALK, *((*r, "x", 1) for r in rows))
    want = plain_trie(rows)
    for parts in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = [tuple(r[c] for c in NODE) for r in trie.rebuilt_trie(talk).collect()]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert len(got) == len(want) and set(got) == want
    assert trie.rebuilt_trie(talk.limit(0)).count() == 0


def test_queue_spills_and_keeps_the_order():
    chance = np.random.default_rng(1)
    queue, held = trie.SpillingQueue(2, most=50), []
    for round_ in range(40):
        for row in chance.integers(0, 1000, (30, 2)).tolist():
            queue.push(tuple(row))
            held.append(tuple(row))
        for _ in range(20):
            assert queue.head() == min(held)
            held.remove(queue.pop())
    assert len(queue.runs) > 5
    assert [queue.pop() for _ in range(len(held))] == sorted(held) and queue.head() is None


def test_totals_with_a_spilling_queue(frame, monkeypatch):
    monkeypatch.setattr(trie, "QUEUE", 3)
    rows = [(c, t, "user", f"{c >> max(0, 6 - t)}") for c in range(64) for t in range(7)]
    talk = frame(TALK, *((*r, "x", 1) for r in rows))
    assert {tuple(r[c] for c in NODE) for r in trie.rebuilt_trie(talk).collect()} == plain_trie(rows)


# --- Ranked search ---------------------------------------------------------------------------------------------------

TERM = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def plain_terms(text: str | None) -> list[str]:
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_ranking(docs: list[tuple], items: list[tuple]) -> Counter:
    counts = [(d, Counter(plain_terms(t))) for d, t in docs]
    size = [sum(c.values()) for _, c in counts]
    n_docs, total = sum(s > 0 for s in size), sum(size)
    df = Counter(t for _, c in counts for t in c)
    found = Counter()
    for item, text in items:
        own, scored = set(plain_terms(text)), []
        for (doc, c), n in zip(counts, size):
            score = 0
            for t in own:
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // total)))
            if score > 0:
                scored.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:10], 1):
            found[item, rank, doc, -score] += 1
    return found


def ranking(docs, items) -> Counter:
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in fptree.ranked_documents(docs, items).collect())


@pytest.mark.parametrize("block,at_once", [(2_000_000, 5_000), (60, 4)])
def test_ranked_documents_against_brute_force(frame, monkeypatch, block, at_once):
    monkeypatch.setattr(fptree, "BLOCK", block)
    monkeypatch.setattr(fptree, "ITEMS", at_once)
    chance = random.Random(3)
    docs = [(i, invented(i, chance.randrange(0, 60), 40)) for i in range(150)]
    docs += [(1000 + i, invented(7, 30, 40)) for i in range(25)] + [(5, "w1x W2X"), (None, "w1x w2x w3x"), (2000, None), (2001, ""), (2002, "w1x " * 30_000), (2003, "É1 é1 ÄB äb a_b A.B")]
    items = [(i, invented(900 + i, chance.randrange(1, 20), 40)) for i in range(9)] + [(9, None), (10, "?!"), (11, "nowhere found"), (None, "w5x w5x w6x"), (3, "w9x"), (12, "É1 äB A"), (13, "w1x " + "z" * 5000)]
    got = ranking(frame(DOCS, *((d, t, 1, "x", "y") for d, t in docs)), frame("item_id long, text string, score int", *((i, t, 1) for i, t in items)))
    assert got == plain_ranking(docs, items)


def test_ranked_documents_of_empty_tables(frame):
    docs, items = frame(DOCS, (1, "a b", 1, "x", "y")), frame("item_id long, text string", (1, "a"))
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        made = fptree.ranked_documents(a, b)
        assert made.count() == 0 and made.columns == ["item_id", "rank", "doc_id", "score"]


def test_search_leaves_subtrees_out():
    chance = np.random.default_rng(6)
    size = chance.integers(3, 12, 3000)
    start = np.concatenate([[0], np.cumsum(size)])
    rank = np.concatenate([np.sort(chance.choice(60, n, replace=False, p=np.arange(60, 0, -1) / 1830)) for n in size])
    tf, m = chance.integers(1, 9, len(rank)), chance.integers(10, 400, 3000)
    tree = fptree.Tree(np.arange(3000), start, rank, tf, m)
    assert len(tree.node) < len(rank)
    ranks, weights, top = [2, 11, 30, 55], [700, 1900, 3000, 5200], []
    visited = fptree.search(tree, ranks, weights, top)
    of = dict(zip(ranks, weights))
    plain = sorted(((sum(of.get(int(r), 0) * (1_000_000_000 * int(t) // (1000 * int(t) + 8 * int(m[d]))) for r, t in zip(rank[start[d] : start[d + 1]], tf[start[d] : start[d + 1]])), -d) for d in range(3000)), reverse=True)
    assert sorted(top, reverse=True) == plain[:10]
    assert visited < sum(np.isin(tree.label, ranks)) / 3


@pytest.mark.parametrize("name", ["op12_trie", "op13_ranked"])
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), duck(SMALL), ORACLES[name]) is None


def test_fingerprint_query(spark):
    got = QUERIES["op11_fingerprints"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert got.count() == docs.count() and got.where("near_edited < 0 OR near_edited > 1 OR near_next < 0 OR near_next > 1").count() == 0
    assert abs(got.agg(F.avg("near_edited")).first()[0] - 0.33) < 0.1 and got.agg(F.percentile("near_next", F.lit(0.5))).first()[0] < 0.05
