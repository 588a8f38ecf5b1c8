"""Operators over the whole corpus: corner cases and comparisons with brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL, values
from pyspark.sql import functions as F

import corpus_pipeline
from fieldlab.llm import decontam, kernels, licenses, neardup, passages, quality, suffixes
from fieldlab.llm.queries import QUERIES

DOCS = "doc_id long, text string, n long, hash string"
BLANK = "[^\x20\x09-\x0d]+"


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def invented(seed: int, n: int, vocabulary: int = 3000) -> str:
    chance = random.Random(seed)
    return " ".join(f"w{chance.randrange(vocabulary)}x" for _ in range(n))


@pytest.fixture(scope="module")
def given(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


# --- Kernels ---------------------------------------------------------------------------------------------------------


def test_kernels_against_plain_versions():
    chance = np.random.default_rng(5)
    values = chance.integers(0, 9, 300).astype(np.uint64)
    for width in (1, 2, 3, 10, 64):
        plain = [i + int(np.argmin(values[i : i + width])) for i in range(len(values) - width + 1)]
        assert kernels.sliding_argmin(values, width).tolist() == plain
    rows = chance.integers(97, 100, (5000, 11)).astype(np.uint8)
    order = kernels.multikey_order(kernels.row_words(rows), cutoff=16)
    assert order.tolist() == sorted(range(len(rows)), key=lambda i: (rows[i].tobytes(), i))
    begin, count = np.array([5, 0, 9]), np.array([2, 0, 3])
    assert kernels.ranges(begin, count).tolist() == [5, 6, 9, 10, 11]
    raw = " ab\tc  é\n".encode() + b"d e"
    data, at = np.frombuffer(raw, np.uint8), np.array([0, 10, 10, len(raw)])
    a, b, first, hashes = kernels.word_hashes(data, at)
    assert [raw[x:y] for x, y in zip(a, b)] == [b"ab", b"c", "é".encode(), b"d", b"e"] and first.tolist() == [0, 3, 3, 5]
    assert len(set(hashes.tolist())) == 5


# --- Licenses --------------------------------------------------------------------------------------------------------


def plain_scan(text: str) -> tuple:
    found = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        hits = [i for i in range(len(found) - len(own) + 1) if found[i : i + len(own)] == own]
        places += hits
        labels |= {label} if hits else set()
    return len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_base_and_labels(frame, given):
    notice = licenses.TEMPLATES[3][1].split()
    edited = " ".join(w for i, w in enumerate(notice) if i != 20)
    texts = [
        *[t for t in given.values() if "icense" in t][:30], *list(given.values())[:20], None, "", "...", "mit license", "MIT-License; mit_license mit license mit license",
        "smit license, mit licenses", "the general public\nlicense and Apache \t License", "éMIT License MİT license mit éx license", invented(1, 20) + " " + edited + " " + invented(2, 20),
        invented(3, 5) + " Licensed under CC BY-NC 4.0. " + invented(4, 5), "mit " * 20_000 + "license",
    ]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    docs = frame(DOCS, *rows, rows[3], (None, "mit license", 1, "x"))
    got = licenses.scanned(docs)
    assert got.count() == len(rows) + 2
    told = {r["doc_id"]: r for r in got.collect()}
    for i, t in enumerate(texts):
        assert tuple(told[i][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == plain_scan(t or "")
        assert set(filter(None, told[i]["base_labels"].split(","))) <= set(told[i]["labels"].split(",")) and 0 <= told[i]["score"] <= 1
    assert told[len(texts) - 3]["labels"] == "mit" and told[len(texts) - 3]["n_base"] == 0 and told[len(texts) - 3]["score"] > 0.8
    assert told[len(texts) - 2]["labels"] == "cc-by-nc" and told[None]["labels"] == "mit"
    assert licenses.scanned(docs.limit(0)).count() == 0


def test_diagonals_of_inserted_words_are_merged(frame):
    keyed = frame("doc_id long, n int, text string", (1, 0, "so: Licensed under the Apache License, really, Version 2.0 (the \"License\") you may not use this file"))
    assert values(licenses.spans(keyed, [("t", "Licensed under the Apache License Version 2.0 the License you may not use this file")]).select("label", "first_word")) == [("t", 1)]


# --- Suffixes --------------------------------------------------------------------------------------------------------


def plain_removal(texts: list[tuple]) -> dict:
    """By document: bytes, removed bytes, runs and digest of the rest."""
    seen, told = set(), {}
    for key, text in texts:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - suffixes.LENGTH + 1):
            window = raw[i : i + suffixes.LENGTH]
            if window in seen:
                gone[i : i + suffixes.LENGTH] = b"\1" * suffixes.LENGTH
            seen.add(window)
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        told[key] = (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(rest).hexdigest())
    return told


def removal(docs) -> dict:
    made = suffixes.deduplicated(docs).select(
        "doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["stop"] - s["start"]).alias("gone"), F.size("spans").alias("runs"), F.sha2("kept", 256).alias("rest")
    )
    return {r["doc_id"]: tuple(r)[1:] for r in made.collect()}


def shared_texts() -> list[tuple]:
    """Copies, edited copies, shared passages with changing surroundings, runs of one letter, periods, empties."""
    chance = random.Random(11)
    base, passage, line = invented(1, 200, 50), invented(2, 25), invented(3, 14)
    texts = [base, base, passage + base[:90], line, line + "!", "", "a" * 600, "b" + "a" * 350, "ab" * 200, "abc" * 120, "x" * 99, "x" * 100]
    for i in range(60):
        own = base.split()
        for _ in range(i % 7):
            own[chance.randrange(len(own))] = f"edit{i}"
        texts.append(" ".join(own))
        texts.append(invented(100 + i, chance.randrange(40)) + passage + invented(200 + i, chance.randrange(40)) + line + f" {i}")
    return list(enumerate(texts))


def test_removed_bytes_equal_brute_force(frame, given, spark):
    texts = shared_texts() + [(1000 + i, t) for i, t in sorted(given.items())[:80]]
    docs = frame(DOCS, *((i, t, 1, "x") for i, t in texts))
    assert removal(docs) == plain_removal(texts)
    for parts in ("1", "40"):  # one bucket; more buckets than some k-grams have rows
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            assert removal(docs) == plain_removal(texts)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pieces_of_long_texts(frame, monkeypatch):
    texts = shared_texts()[:20] + [(50, " ".join(t for _, t in shared_texts()))]
    for piece in (700, 1500):
        found = [suffixes.anchors_of(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])) for _, t in texts]
        monkeypatch.setattr(suffixes, "PIECE", piece)
        for (_, t), whole in zip(texts, found):
            raw = np.frombuffer(t.encode(), np.uint8)
            covered = set()
            for part, limits, number, shift in suffixes.pieces(raw, np.array([0, len(raw)])):
                _, where, lo, hi, _, _ = suffixes.anchors_of(part, limits)
                covered |= {(w + shift[0], x + shift[0]) for w, a, b in zip(where, lo, hi) for x in range(a, b + 1)}
            assert covered == {(w, x) for w, a, b in zip(whole[1], whole[2], whole[3]) for x in range(a, b + 1)}


def test_suffix_corner_cases(frame):
    long = invented(5, 40)
    docs = frame(DOCS, (None, long, 1, "x"), (1, long, 1, "x"), (1, long, 1, "x"), (2, None, 1, "x"), (3, "", 1, "x"))
    got = sorted((str(r[0]), r[1]) for r in suffixes.deduplicated(docs).select("doc_id", F.size("spans")).collect())
    assert got == [("1", 1), ("1", 1), ("2", 0), ("3", 0), ("None", 0)]
    assert suffixes.deduplicated(docs.limit(0)).count() == 0


# --- Near-duplicates -------------------------------------------------------------------------------------------------


def plain_set(text: str | None) -> set:
    found = re.findall(BLANK, lower(text or ""))
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} - {()}


def plain_groups(texts: dict, share: int = 85) -> dict:
    sets = {i: plain_set(t) for i, t in texts.items()}
    of = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            of[x].append(i)
    shared = Counter((a, b) for own in of.values() for a in own for b in own if a < b)
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= share * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in texts}


def near_texts() -> dict:
    """Groups around the threshold: a drifting line of copies, a star of copies, copies of unlike originals that share a passage."""
    chance = random.Random(4)
    texts, now = {}, invented(9, 150).split()
    star = invented(10, 150).split()
    for i in range(120):
        if i % 3 == 0:
            now = list(now)
            now[chance.randrange(150)] = f"drift{i}"
            texts[i] = " ".join(now)
        elif i % 3 == 1:
            own = list(star)
            for _ in range(chance.randrange(1, 5)):
                own[chance.randrange(150)] = f"edit{i}"
            texts[i] = " ".join(own)
        else:
            texts[i] = invented(500 + i, 30) + " " + invented(10, 100)
    return texts


def test_components_equal_brute_force(frame, given):
    texts = near_texts() | {1000 + i: t for i, t in given.items()}
    texts |= {2000: "one two", 2001: "ONE  two", 2002: "one two three", 2003: "", 2004: " \n", 2005: "one two three four five", 2006: "one two three four five six"}
    docs = frame(DOCS, *((i, t, 1, "x") for i, t in sorted(texts.items(), key=lambda x: hash(x[1]))))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.grouped(docs).collect()}
    assert got == plain_groups(texts)


def morse(size: int, swap: bool) -> str:
    """A Thue-Morse word of two letters: it and the one with letters swapped have equal polynomials modulo 2 ** 64."""
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(size))


@pytest.mark.parametrize("size", [1024, 4096])
def test_long_unlike_words_do_not_collide(frame, size):
    a, b = morse(size, False), morse(size, True)
    _, _, _, hashes = kernels.word_hashes(np.frombuffer(f"{a} {b}".encode(), np.uint8), np.array([0, 2 * size + 1]))
    assert hashes[0] != hashes[1]
    docs = frame(DOCS, (1, f"one two three four {a}", 1, "x"), (2, f"one two three four {b}", 1, "x"))
    assert sorted(r["component_id"] for r in neardup.grouped(docs).collect()) == [1, 2]
    once = " ".join(f"v{i}" for i in range(4))
    text = f"{once} {a} x y z {once} {b}"
    assert quality.measures(frame("doc_id long, text string, source string", (1, text, "s"))).first()["n_repeat_words"] == 0
    passage = " ".join(morse(size, i % 2 == 0) for i in range(60))
    other = " ".join(morse(size, i % 3 == 0) for i in range(60))
    assert passages.repeated(frame(DOCS, (1, passage, 1, "x"), (2, other, 1, "x"))).count() == 0


def test_strays_are_found_in_shards(frame, monkeypatch):
    # Stars alone miss the links of the drifting line; small shards must not lose any.
    monkeypatch.setattr(neardup, "SHARD", 7)
    texts = near_texts()
    docs = frame(DOCS, *((i, t, 1, "x") for i, t in texts.items()))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.grouped(docs).collect()}
    assert got == plain_groups(texts)


def test_near_duplicate_corner_cases(frame):
    a, b = invented(1, 60), invented(2, 60)
    docs = frame(DOCS, (None, a, 1, "x"), (5, a, 1, "x"), (5, b, 1, "x"), (7, b, 1, "x"), (7, b, 1, "x"), (9, None, 1, "x"), (10, "", 1, "x"), (11, a, 1, "x"))
    got = values(neardup.grouped(docs).select("doc_id", "component_id"))
    assert got == [(10, 10), (11, 5), (5, 5), (5, 5), (7, 5), (7, 5), (9, 9), (None, None)]
    assert neardup.grouped(docs.limit(0)).count() == 0


def test_components_of_long_lines(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300) if i != 150] + [(900, 900)], "l long, r long")
    got = dict(values(neardup.components(edges)))
    assert got == {i: 0 if i <= 150 else 151 for i in range(301)}


def test_stage_joins_near_copies_from_080(spark, frame):
    text = invented(1, 104).split()  # 100 shingles
    other = [*text[:50], "a", *text[51:70], "b", *text[71:]]  # 90 of them in 110: 0.818
    docs = frame("doc_id long, text string, lang string, source string, n_chars long", (1, " ".join(text), "en", "s", 1), (2, " ".join(other), "en", "s", 1))
    assert len(plain_set(" ".join(text)) & plain_set(" ".join(other))) == 90
    assert [r["doc_id"] for r in corpus_pipeline.one_of_near_copies(spark, docs, SMALL).collect()] == [1]
    assert {r["component_id"] for r in neardup.grouped(docs).collect()} == {1, 2}


# --- Passages --------------------------------------------------------------------------------------------------------


def test_passages_are_found_and_cut(frame):
    passage = invented(1, 60)
    fuzzy = passage.split()
    fuzzy[20] = "other"
    del fuzzy[41]
    fuzzy = " ".join(fuzzy)
    texts = {
        1: invented(11, 80) + " " + passage + " " + invented(12, 30), 2: invented(13, 50) + "\n" + passage.upper() + "\n" + invented(14, 50),
        3: invented(15, 40) + " " + fuzzy + " " + invented(16, 200), 4: invented(17, 300), 5: passage, 6: invented(18, 20) + " " + " ".join(passage.split()[:30]),
    }
    docs = frame(DOCS, *((i, t, 1, "x") for i, t in texts.items()), (7, None, 1, "x"), (8, "", 1, "x"))
    found = passages.repeated(docs)
    spans = {(r["doc_id"], r["first_word"], r["end_word"]) for r in found.collect()}
    assert {(2, 50, 110), (5, 0, 60)} <= spans and {s[0] for s in spans} == {2, 3, 5}
    assert all(abs(a - 40) <= 2 and abs(b - 99) <= 2 for d, a, b in spans if d == 3)
    cut = passages.without_passages(docs, found)
    assert cut.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert left[2].split() == (invented(13, 50) + " " + invented(14, 50)).split() and left[5] == ""
    assert all(left[i] == texts[i] for i in (1, 4, 6)) and left[7] is None and left[8] == ""
    assert passages.repeated(docs.limit(0)).count() == 0


def test_repeated_rows_do_not_empty_each_other(frame):
    text = invented(1, 100)
    docs = frame(DOCS, (1, text, 1, "x"), (1, text, 1, "x"), (None, text, 1, "x"))
    # Null comes first; both rows of document 1 repeat it.
    left = [tuple(r) for r in passages.without_passages(docs, passages.repeated(docs)).select("doc_id", "text").collect()]
    assert sorted(left, key=str) == sorted([(1, ""), (1, ""), (None, text)], key=str)


def test_exact_passages_of_the_given_documents(frame, given):
    seen, expected = {}, set()
    for i, t in sorted(given.items()):
        own = [tuple(w) for w in zip(*(lower(t).split()[k:] for k in range(50)))]
        if any(seen.get(w, i) != i for w in own):
            expected.add(i)
        for w in own:
            seen.setdefault(w, i)
    docs = frame(DOCS, *((i, t, 1, "x") for i, t in given.items()))
    assert expected <= {r["doc_id"] for r in passages.repeated(docs).select("doc_id").distinct().collect()}


def test_chains_prefer_order():
    pos, src = np.array([0, 5, 10, 15, 20, 400]), np.array([100, 105, 50, 115, 120, 130])
    assert [c.tolist() for c in passages.chains_of(pos, src)] == [[0, 1, 3, 4]]


@pytest.mark.parametrize(("head", "tail"), [(30, 30), (47, 13), (40, 20)])
def test_whole_passage_between_its_parts(frame, head, tail):
    """Its parts are in documents that come first and just before; only document 10 has the whole passage."""
    words = invented(1, 60).split()
    parts = {1: words[:head], 15: words[:head], 2: words[tail:], 16: words[tail:], 10: words, 20: words}
    texts = {i: " ".join([invented(100 + i, 70), *p, invented(200 + i, 70)]) for i, p in parts.items()}
    found = passages.repeated(frame(DOCS, *((i, t, 1, "x") for i, t in texts.items()))).collect()
    # Brute force: places of the later documents whose 50 words an earlier one has.
    seen, expected = set(), {}
    for i, t in sorted(texts.items()):
        own = [tuple(w) for w in zip(*(t.split()[k:] for k in range(50)))]
        expected[i] = {p + k for p, w in enumerate(own) if w in seen for k in range(50)}
        seen.update(own)
    got = {i: {w for r in found if r["doc_id"] == i for w in range(r["first_word"], r["end_word"])} for i in texts}
    assert got == expected and len(expected[20]) == 60


def test_equal_chains_do_not_depend_on_their_order(frame, tmp_path, monkeypatch):
    """Document 9 has its passage from 1 and 8, equally long; whichever pair arrives first in a part, the first source is told."""
    monkeypatch.setattr(passages, "PARTS", 1)
    p = invented(1, 60)
    docs = frame(DOCS, *((i, f"{invented(10 + i, 30)} {p if i < 3 or i > 7 else ''} {invented(20 + i, 30)}", 1, "x") for i in range(1, 10)))
    keyed = passages._keyed(docs, "doc_id", "text")
    words = passages.hashed_words(keyed)
    pairs = passages.chains(passages.links(passages.seeds(keyed)))
    passages.with_source_words(words, pairs).write.parquet(f"{tmp_path}/sourced")
    sourced = docs.sparkSession.read.parquet(f"{tmp_path}/sourced")
    found = [values(passages.passages_of(words, sourced.coalesce(1).orderBy(order))) for order in (F.asc("src"), F.desc("src"))]
    assert found[0] == found[1] and {r[4] for r in found[0] if r[0] == 9} == {1}


def test_every_copy_of_an_earlier_passage(frame, monkeypatch):
    p, q = invented(1, 60), invented(2, 60).split()
    texts = {
        1: f"{invented(3, 40)} {p} {invented(4, 40)}", 2: f"{invented(5, 40)} {p} {invented(6, 40)} {p} {invented(7, 40)}",
        # The source has the passage's words in pieces before it.
        3: " ".join([*q[:30], invented(8, 40), *q[30:], invented(9, 40), *q]), 4: " ".join([invented(10, 40), *q, invented(11, 40)]),
    }
    docs = frame(DOCS, *((i, t, 1, "x") for i, t in texts.items()))
    spans = {(2, 40, 100), (2, 140, 200), (4, 40, 100)}
    assert {(r["doc_id"], r["first_word"], r["end_word"]) for r in passages.repeated(docs).collect()} == spans
    monkeypatch.setattr(passages, "PLACES", 1)
    assert spans == {(r["doc_id"], r["first_word"], r["end_word"]) for r in passages.repeated(docs).collect()}


@pytest.mark.parametrize("kind", ["equal", "substituted", "shifted"])
def test_passage_of_neither_the_first_nor_the_previous_document(frame, kind):
    """All documents share a line of 12 words; only 10 and 20 have the words beside it, and all their other k-mers lie in others too."""
    words = invented(1, 54).split()
    other = list(words)
    if kind != "equal":
        other[4::13] = [f"edit{i}" for i in range(len(other[4::13]))]
    if kind == "shifted":
        other[34:34] = ["more"]
    # Each k-mer of the passage is in documents that come first and just before, without the words beside it.
    cuts = [words[a : a + 14] for a in (*range(0, 40, 6), 40)]
    others = {k * 100 + j: cut for k in (0, 1) for j, cut in enumerate(cuts)}
    parts = {(i + 1 if i < 100 else i): p for i, p in others.items()}
    parts |= {20: words, 900: other}
    texts = {i: " ".join([invented(1000 + i, 70), *parts[i], invented(3000 + i, 70)]) for i in sorted(parts)}
    found = passages.repeated(frame(DOCS, *((i, t, 1, "x") for i, t in texts.items()))).collect()
    assert {(r["doc_id"], r["source_id"]) for r in found} == {(900, 20)}
    covered = {w for r in found for w in range(r["first_word"], r["end_word"])}
    assert len(covered) >= len(other) - 4 and min(covered) >= 68 and max(covered) <= 72 + len(other)


def test_strays_in_tiles_and_blocks(frame, monkeypatch):
    """Small tiles and blocks lose no pair, whichever documents of a line share a passage; a null id comes first."""
    line = invented(1, 10).split()
    tails = {j: invented(300 + j, 46).split() for j in range(4)}
    ids = [None, *range(1, 40)]
    texts = {}
    for k, i in enumerate(ids):
        tail = tails.get({0: 0, 3: 1, 5: 2, 17: 1, 20: 0, 33: 2, 36: 1}.get(k), [])
        # All k-mers of a tail are in many documents, each in a piece of its own.
        pieces = [w for j in tails for w in [*tails[j][6 * (k % 7) : 6 * (k % 7) + 12], invented(5000 + 4 * k + j, 40)]]
        texts[i] = " ".join([invented(500 + k, 70), *line, *tail, invented(600 + k, 70), *pieces])
    docs = frame(DOCS, *((i, t, 1, "x") for i, t in texts.items()))
    expected = {(20, None), (17, 3), (33, 5)}
    got = []
    for tile, block in ((8192, 512), (5, 3)):
        monkeypatch.setattr(passages, "TILE", tile)
        monkeypatch.setattr(passages, "BLOCK", block)
        found = passages.repeated(docs).collect()
        pairs = {(r["doc_id"], r["source_id"]) for r in found}
        assert expected <= pairs and {d for d, _ in pairs} == {17, 20, 33, 36}
        got.append(sorted({(r["doc_id"], r["first_word"], r["end_word"]) for r in found}))
    assert got[0] == got[1]


def test_strays_of_runs_over_batches_and_buckets(spark, frame):
    """Every place of a k-mer of STRAY documents is a stray, however its run is cut into batches."""
    rows = [(h << 2, d, 0, p) for h, many in ((1, 3), (2, 4), (3, 9), (4, 5000), (5, 2)) for d in range(many) for p in (5, 90)]
    seeds = frame("hash long, doc_id long, n int, pos int", *rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "3"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = {(r["src_pos"], r["doc_id"], r["pos"]) for r in passages.links(seeds, strays=True).where(passages._itself()).collect()}
            assert got >= {(h >> 2, d, p) for h, d, _, p in rows if h >> 2 in (2, 3, 4)}
            assert all(r["doc_id"] != r["src"] for r in passages.links(seeds).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def stray_rows(docs):
    """Tiles and links of strays of which no words are found yet."""
    keyed = passages._keyed(docs, "doc_id", "text")
    pairs = passages.chains(passages.links(passages.seeds(keyed), strays=True))
    none = docs.limit(0).selectExpr("doc_id", "0 AS n", "0 AS first_word", "0 AS end_word")
    tiled = passages.tiles(passages.hashed_words(keyed), passages.stray_places(pairs, none))
    return tiled, passages.stray_links(tiled)


def test_runs_of_a_word_give_each_link_once(frame):
    """All places of runs of a word are strays; a pair of documents has their links once, not once for each pair of places."""
    tail = invented(1, 30)
    texts = {i: " ".join([invented(100 + i, 70), *["in"] * (34 + i), tail if i in (5, 9) else invented(200 + i, 30), invented(300 + i, 70)]) for i in range(12)}
    docs = frame(DOCS, *((i, t, 1, "x") for i, t in texts.items()))
    got = [tuple(r) for r in stray_rows(docs)[1].collect()]
    assert {(r[0], r[3]) for r in got} >= {(9, 5)} and len(got) < 1.5 * len(set(got)) < 66 * 45 * 45
    found = passages.repeated(docs).collect()
    assert {(r["doc_id"], r["source_id"]) for r in found} == {(9, 5)}
    covered = {w for r in found for w in range(r["first_word"], r["end_word"])}
    assert covered >= set(range(70 + 43 - 39, 70 + 43 + 30)) and max(covered) < 70 + 43 + 30 + 8


def test_places_without_a_pair_are_left_out(frame):
    """Of places that are not open only those before an open one of another document are compared."""
    texts = {i: f"{invented(1, 8)} {invented(10 + i, 60)}" for i in range(6)}
    keyed = passages._keyed(frame(DOCS, *((i, t, 1, "x") for i, t in texts.items())), "doc_id", "text")
    words = passages.hashed_words(keyed)
    places = [(1, d, 0, 0, d == 3) for d in range(6)] + [(2, d, 0, 1, d == 0) for d in range(6)] + [(3, 4, 0, p, True) for p in range(3)]
    tiled = passages.tiles(words, frame("key int, doc_id long, n int, pos int, open boolean", *places)).collect()
    assert sorted((r["key"], r["doc_id"], r["open"]) for r in tiled) == [(1, 0, 0), (1, 1, 0), (1, 2, 0), (1, 3, 1)]


def stray_places_of(texts, rows):
    """Rows (tile, document, place, run, open) of documents given as lists of word hashes."""
    m = passages.MARGIN
    beside = [np.array(texts[d][max(0, p - m) : p + passages.SEED + m], np.uint16).tobytes() for _, d, p, _, _ in rows]
    tile, doc, pos, run, open_ = (np.array(c) for c in zip(*rows))
    same = np.zeros(len(rows), np.int32)
    table = pa.table({
        "lo": same, "hi": same, "part": same, "doc_id": doc, "n": same, "pos": pos.astype(np.int32), "run": run.astype(np.int32),
        "open": open_.astype(np.int32), "beside": pa.array(beside, pa.binary()),
    })
    return passages._Places(table, tile)


def test_compared_places(monkeypatch):
    """Small and large tiles give the pairs that counting gives, but for those that go on from the pair before."""
    rng = np.random.default_rng(3)
    texts = [rng.choice(np.arange(1, 400) ** 2 % 4093, 150, p=(w := 1 / np.arange(1, 400)) / w.sum()) for _ in range(40)]
    for t in texts[::2]:
        t[60:95] = 7
    rows = [(d % 3, d, p, int(p > 62), 1 + int(p > 62) if (d + p) % 3 else 0) for d in range(40) for p in (30, 62, 63, 64, 70)]
    p = stray_places_of(texts, rows)
    expected = set()
    for t in range(len(rows)):
        for s in range(len(rows)):
            if p.tile[t] == p.tile[s] and p.doc[s] < p.doc[t] and p.open[t] and (p.open[t] < 2 or p.run[t] != p.run[s]):
                mine, other = p.beside[t], p.beside[s]
                met = np.isin(mine, other[other >= 0])[passages.LOW : passages.HIGH].astype(int)
                likely = max(met[i : i + 50].sum() for i in range(len(met) - 49)) >= passages.LEAST_ALIKE
                if likely and np.isin(other, mine[mine >= 0]).sum() >= passages.LEAST_ALIKE:
                    expected.add((t, s))
    assert len(expected) > 100
    for block in (512, 7):
        monkeypatch.setattr(passages, "BLOCK", block)
        got = [(int(t), int(s)) for one, other in passages._alike(p) for t, s in zip(one, other)]
        assert len(got) == len(set(got)) and set(got) == expected


def test_places_of_passages_are_never_passed_over():
    """Whatever is replaced, left out or put in, each common k-mer of a passage with IDENTITY tells that there may be one."""
    rng = np.random.default_rng(4)
    for trial in range(150):
        size = int(rng.integers(50, 121))
        source = rng.integers(1, 4000, size).tolist() if trial % 3 else [int(v) for v in np.repeat(rng.integers(1, 4000, size), 20)[:size]]
        other, at, edits = [], [], 0
        for i, word in enumerate(source):
            if 4 < i < size - 5 and edits < 0.18 * size and rng.random() < 0.25:
                edits += 1
                other += ([9000 + i], [], [word, 9000 + i])[rng.integers(3)]
            else:
                at.append((len(other), i))
                other.append(word)
        if len(other) < 50:
            continue
        texts = [[*rng.integers(4000, 8000, 90), *source, *rng.integers(4000, 8000, 90)], [*rng.integers(4000, 8000, 90), *other, *rng.integers(4000, 8000, 90)]]
        for k in range(len(at) - 3):
            if at[k + 3] == (at[k][0] + 3, at[k][1] + 3):
                p = stray_places_of(texts, [(0, 0, at[k][1] + 90, 0, 0), (0, 1, at[k][0] + 90, 0, 1)])
                assert passages._passable(p, np.array([1]), np.array([0]))[0]


def test_shuffle_files_go_with_their_step(spark, frame, monkeypatch):
    p = invented(1, 60)
    docs = frame(DOCS, *((i, f"{invented(2 + i, 40)} {p} {invented(50 + i, 40)}", 1, "x") for i in range(20)))
    blocks = lambda: {b for b in str(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()).split() if "shuffle_" in b}
    before, left = blocks(), []
    for name in ("with_source_words", "passages_of"):
        step = getattr(passages, name)
        monkeypatch.setattr(passages, name, lambda *a, step=step: (left.append(blocks() - before), step(*a))[1])
    assert {r["doc_id"] for r in passages.repeated(docs).collect()} == set(range(1, 20))
    assert left == [set(), set()]


@pytest.mark.parametrize(("size", "identity", "least"), [(50, 0.8, 0.9), (60, 0.8, 0.93), (50, 0.83, 0.9), (50, 0.9, 0.95), (60, 0.83, 0.95), (120, 0.83, 0.95)])
def test_recall_of_fuzzy_passages(frame, size, identity, least):
    """Evenly spread substitutions, first and last word equal."""
    rows, trials = [], 100
    for k in range(trials):
        words = invented(1000 + k, size).split()
        edits = round(size * (1 - identity))
        other = list(words)
        for e in range(edits):
            other[int((e + 0.5) * size / edits)] = f"edit{k}n{e}"
        rows += [(k, " ".join([invented(2000 + k, 60, 10**9), *words, invented(3000 + k, 60, 10**9)]), 1, "x")]
        rows += [(500 + k, " ".join([invented(4000 + k, 60, 10**9), *other, invented(5000 + k, 60, 10**9)]), 1, "x")]
    got = {r["doc_id"] for r in passages.repeated(frame(DOCS, *rows)).collect() if r["source_id"] == r["doc_id"] - 500}
    assert len(got) >= least * trials


# --- Decontamination -------------------------------------------------------------------------------------------------


def test_leaks_and_paraphrases(frame):
    items = {1: invented(1, 40), 2: invented(2, 30), 3: invented(3, 60), 4: "", 5: None}
    loose = items[3].split()
    for i in range(5, 60, 6):
        loose[i] = "changed"
    texts = {i: invented(100 + i, 200) for i in range(60)}
    texts[3] += " " + items[1].upper() + " " + invented(7, 70)
    texts[9] = items[2]
    texts[12] = invented(8, 33) + "\n" + " ".join(loose) + " " + invented(9, 10)
    texts[15] = " ".join(random.Random(1).sample(items[1].split(), 40))  # same words, no order
    docs = frame(DOCS, *((i, t, 1, "x") for i, t in texts.items()), (70, None, 1, "x"), (71, "", 1, "x"), (None, items[2], 1, "x"))
    asked = frame("item_id long, text string", *items.items())
    found = decontam.leaks(docs, asked)
    got = {(r["doc_id"], r["item_id"]): r for r in found.collect()}
    assert set(got) == {(3, 1), (9, 2), (12, 3), (None, 2)}
    assert (got[3, 1]["first_word"], got[3, 1]["end_word"], got[3, 1]["overlap"]) == (200, 240, 1.0)
    clean = decontam.without_leaks(docs, found)
    assert clean.columns == docs.columns and {r[0] for r in clean.select("doc_id").collect()} == {*texts, 70, 71} - {3, 9, 12}
    assert decontam.leaks(docs.limit(0), asked).count() == 0 and decontam.leaks(docs, asked.limit(0)).count() == 0


def test_items_in_blocks(frame, monkeypatch):
    items = {i: invented(i, 30) for i in range(7)}
    docs = frame(DOCS, *((i, invented(50 + i, 60) + " " + t, 1, "x") for i, t in items.items()))
    asked = frame("item_id long, text string", *items.items())
    monkeypatch.setattr(decontam, "ITEM_BLOCK", 3)
    assert {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, asked).collect()} == {(i, i) for i in range(7)}


def test_given_items_are_found(spark):
    folder = "/root/testdata/sf0.01"
    squeezed = {r["doc_id"]: " ".join(lower(r["text"]).split()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r["item_id"]: " ".join(lower(r["text"]).split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    inside = {(d, i) for d, t in squeezed.items() for i, x in items.items() if x in t}
    assert {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_decontam"](spark, folder).collect()} == inside


def paraphrases(spark, folder: str) -> tuple:
    """(share of replaced words, item, text) of 40 items, 8 each: words before the last 8 replaced by any of the documents, in random context."""
    chance = random.Random(5)
    items = [decontam.Item(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").collect() if r["text"]]
    texts = {r["item_id"]: lower(r["text"]).split() for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect() if r["text"]}
    words = [w for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").limit(300).collect() for w in lower(r["text"] or "").split()]
    made = []
    for item in [i for i in items if len(i.words) > decontam.ANSWER][:40]:
        for share in (0.3, 0.35, 0.4):
            for _ in range(8):
                told = list(texts[item.id])
                for p in chance.sample(range(len(told) - decontam.ANSWER), min(int(share * len(told)), len(told) - decontam.ANSWER)):
                    told[p] = chance.choice(words)
                a, b = chance.randrange(len(words) - 100), chance.randrange(len(words) - 100)
                made.append((share, item, " ".join([*words[a : a + chance.randrange(20, 100)], *told, *words[b : b + chance.randrange(20, 100)]])))
    return items, made


def test_recall_of_paraphrases(spark):
    folder = "/root/testdata/sf0.01"
    items, made = paraphrases(spark, folder)
    space = decontam.latent_space(*decontam.gathered_counts(spark.read.parquet(f"{folder}/documents.parquet")))
    groups = [decontam.Items([i for i in items if i.scale == k], k, space) for k in sorted({i.scale for i in items})]
    true, found = Counter(), Counter()
    for share, item, text in made:
        raw = np.frombuffer(text.encode(), np.uint8)
        hashes, columns, first = decontam._features(raw, np.array([0, len(raw)]))
        if item.checked(hashes.tolist()):  # brute force over the whole text
            true[share] += 1
            found[share] += any(r[1] is item for r in decontam._leaks_of(columns, hashes, first, space, groups))
    assert all(true[s] > 100 and found[s] >= 0.9 * true[s] for s in (0.3, 0.35, 0.4))


# --- Pipeline --------------------------------------------------------------------------------------------------------


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        if name != "tokens":
            assert after.columns == columns
            left = {r["doc_id"]: r["text"] for r in after.collect()}
        if name == "language":
            assert len(left) >= 0.98 * len(texts)
        elif name == "near_duplicates":
            assert set(left) == {d for d, (_, group) in plain_groups(texts, corpus_pipeline.NEAR).items() if d == group}
        elif name == "passages":
            assert set(left) == set(texts)
            shortened = {d for d in left if left[d] != texts[d]}
            assert all(len(left[d]) < len(texts[d]) for d in shortened)
        elif name == "decontamination":
            items = [" ".join(lower(r["text"]).split()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            leaking = {d for d, t in texts.items() if any(x in " ".join(lower(t).split()) for x in items)}
            assert set(left) == set(texts) - leaking
        else:
            assert after.where("NOT decodes").count() == 0 and after.count() == len(texts)
        docs, texts = after, left


def test_pipeline_over_odd_rows(spark, tmp_path):
    clashing = ["_id", "_n", "n", "ids", "score", "digest", "component", "_text", "_spans", "hash", "_row", "_decoded", "_part", "_key"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in clashing)
    given = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40).withColumns({c: F.lit(1) for c in clashing})
    odd = spark.createDataFrame([r + (1,) * len(clashing) for r in ((None, None, None, None, None), (900, "", "en", None, 0), (901, None, None, "s", None))], schema)
    docs = given.unionByName(odd).unionByName(given.limit(5))
    for stage in (s for _, s in corpus_pipeline.STAGES):
        docs = stage(spark, docs, SMALL)
    assert docs.count() > 0 and docs.select("doc_id").distinct().count() == docs.count()
    none = given.limit(0)
    for stage in (s for _, s in corpus_pipeline.STAGES):
        none = stage(spark, none, SMALL)
    assert none.count() == 0
