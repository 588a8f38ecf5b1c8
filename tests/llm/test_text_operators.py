"""HTML, BPE, chat, language and quality operators: corner cases and comparisons with plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL, values
from pyspark.sql import functions as F

from compare import differences, duck
from fieldlab.llm import bpe, chat, html, language, quality
from fieldlab.llm.queries import ORACLES, QUERIES, held_out, public_vocabulary

DOCS = "doc_id long, text string, source string, ids string, lang string"


# --- HTML ------------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site to make it work for you.</div>
<article><h1>The   title</h1><p>First <b>bold</b> &amp; plain &lt;b&gt;<p>Second
line<br>after break</p><form><input value="x">Sign up</form><aside>Side text here</aside>
<ul><li>One<li>Two</ul></article>
<div id="comments"><p>A reader says a lot of things about this article, at length and with many words.</p></div>
<div class="sidebar"><p>Related stuff</p></div><footer>&copy; Site</footer></body></html>"""


def test_article_only():
    assert html.main_text(PAGE) == "The title\nFirst bold & plain <b>\nSecond line after break\nOne\nTwo"


def test_page_without_article_element():
    text = "A long sentence with many words that make up the story of this page, told at some length. " * 3
    page = (
        "<body><div id=nav><a href=1>Home</a> <a href=2>News</a></div><div class=content>"
        + "".join(f"<p>{i} {text}</p>" for i in range(4))
        + "</div><div class='share'>Tell your friends</div><div class=footer>Imprint</div></body>"
    )
    assert html.main_text(page).split("\n") == [f"{i} {text.strip()}" for i in range(4)]


def test_title_and_layout_names():
    text = "A long sentence with many words that make up the story of this page, told at some length."
    page = (
        "<body class='has-sidebar'><div class='page with-sidebar'><h1>The title</h1><div class='intro'><p>Short intro.</p></div>"
        f"<div class='text'><p>{text}</p><p>{text}</p><p>{text}</p></div><div><a href=1>One</a> <a href=2>Two</a></div></div>"
        "<div class='sidebar'><p>Other stories that are worth your while, surely.</p></div><div class='ad-box'>Buy now</div></body>"
    )
    assert html.main_text(page) == "\n".join(["The title", "Short intro.", text, text, text])
    assert html.main_text("<div class='sidebar'><main><p>inside</p></main><p>x</p></div>") == "inside"
    assert html.main_text("<div class='comment'><p>all there is</p></div>") == "all there is"


def test_sibling_articles_and_names_of_authors():
    text = "A long sentence with many words that make up the story of this page, told at some length."
    page = "<body><nav><a href=1>One</a></nav>" + "".join(f"<article><h2>Part {i}</h2><p>{text}</p><p>{text}</p></article>" for i in range(3)) + "</body>"
    assert html.main_text(page).count(text) == 6 and html.main_text(page).count("Part") == 3
    own = f"<article><p class='side-note'>{text}</p><div class='pagination-info'>{text}</div><section id='search-results-analysis'>{text}</section><div class='sidebar'>{text}</div></article>"
    assert html.main_text(f"<body>{own}</body>").count(text) == 3


def plain_density(page: str) -> str:
    """The text of the subtrees that densities choose, all sums made anew for each node."""
    import math

    root = html.without_suspects(html.parsed(page))
    inside = lambda n: [x for c in n.children if isinstance(c, html.Node) for x in (c, *inside(c))]

    def counts(n):
        chars = sum(len("".join(c.split(" "))) for x in (n, *inside(n)) for c in ["".join("".join(t).split()) for t in x.children if isinstance(t, str)])
        links = sum(counts(x)[0] for x in _tops(n)) if n.tag != "a" else chars
        return chars, links, len(inside(n)), sum(x.tag == "a" for x in inside(n))

    def _tops(n):
        found = []
        for c in n.children:
            if isinstance(c, html.Node):
                found += [c] if c.tag == "a" else _tops(c)
        return found

    c_body, l_body, _, _ = counts(root)

    def density(n):
        chars, links, tags, anchors = counts(n)
        if not chars:
            return 0.0
        base = math.log(chars / max(1, chars - links) * links + l_body / max(1, c_body) * chars + math.e)
        inner = chars / max(1, links) * max(1, tags) / max(1, anchors)
        return chars / max(1, tags) * (math.log(inner) / math.log(base) if base > 1 else 1)

    total = lambda n: sum(density(c) for c in n.children if isinstance(c, html.Node))
    best = max((root, *inside(root)), key=total)
    return "\n".join(html.blocks(best))


def test_given_pages_by_a_plain_density_sum(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").orderBy("page_id").limit(12).collect()]
    for page in pages:
        assert plain_density(page) in html.main_text(page)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain text", "plain text"), ("a < b", "a < b"),
        ("<p>open <b>never closed", "open never closed"), ("</div></p><p>stray", "stray"), ("<script>x", ""), ("<!-- <p>no</p> --><p>yes", "yes"),
        ("<p>&nbsp;a&nbsp;&#98;&#x63;&amp;amp;</p>", "a bc&amp;"), ("<p>un<i>bro</i>ken</p>", "unbroken"), ("<p", ""),
    ],
)
def test_odd_pages(page, text):
    assert html.main_text(page) == text


def test_pages_frame(frame):
    pages = frame("page_id long, html string, text int", (1, None, 7), (2, "<p>x</p>", 7), (2, "<p>x</p>", 7))
    made = html.extracted(pages)
    assert made.columns == ["page_id", "html", "text"]
    assert values(made.select("page_id", "text")) == [(1, ""), (2, "x"), (2, "x")]
    assert html.extracted(pages.limit(0)).count() == 0


def test_deep_and_long_page():
    assert html.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    long = "word " * 100_000
    assert len(html.main_text(f"<article><p>{long}</p></article>")) == len(long.strip())


def test_given_pages_give_their_article(spark):
    import html as reference

    for row in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        inner = re.search("<article>(.*?)</article>", row["html"], re.S)[1]
        parts = [reference.unescape(re.sub("<[^>]*>", "", p)) for p in re.split(r"</?(?:p|h1)[^>]*>", inner)]
        assert html.main_text(row["html"]) == "\n".join(" ".join(p.split()) for p in parts if p.strip())


# --- BPE -------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_vocabulary())


def test_ids_equal_the_library(library):
    chance = random.Random(3)
    own = bpe.tokenizer(public_vocabulary())
    texts = [
        "", " ", "a", "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", " \n\n  two\t", "aaaa" * 3000, "it's we'LL", "日本語 🎉", "　 \xa0x",
        *("".join(chr(chance.choice([chance.randint(32, 126), chance.randint(0xA0, 0xD7FF)])) for _ in range(chance.randint(1, 400))) for _ in range(60)),
    ]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids
        assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_merges_skip_stale_entries():
    def rules(*merges):  # in the order of their ranks: left, right, merged
        return {a << 20 | b: rank << 20 | c for rank, (a, b, c) in enumerate(merges)}

    # a b c: (b, c) merges first, which makes the queued (a, b) stale.
    assert bpe.merged([0, 1, 2], rules((1, 2, 12), (0, 1, 10))) == [0, 12]
    assert bpe.merged([0, 0, 0], rules((0, 0, 1))) == [1, 0]
    assert bpe.merged([0, 0, 0, 0], rules((0, 0, 1), (1, 1, 2))) == [2]


def test_bpe_frame(frame, library):
    docs = frame(DOCS, (1, None, "a", "clash", "en"), (1, None, "a", "clash", "en"), (2, "Hello world", "b", "clash", None))
    made = bpe.encode_decode(docs, public_vocabulary())
    assert made.columns == ["doc_id", "text", "source", "lang", "ids", "decoded"]
    ids = library.encode("Hello world", add_special_tokens=False).ids
    assert values(made.select("doc_id", "ids", "decoded")) == [(1, [], ""), (1, [], ""), (2, ids, "Hello world")]
    assert values(bpe.decode(bpe.encode(docs, public_vocabulary()), public_vocabulary()).select("decoded")) == [("",), ("",), ("Hello world",)]
    assert bpe.encode_decode(docs.limit(0), public_vocabulary()).count() == 0
    digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert values(made.where("doc_id = 2").select(bpe.ids_sha256("ids"))) == [(digest,)]


def test_bpe_query(spark, library):
    got = {r["doc_id"]: r for r in QUERIES["op2_bpe"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"], add_special_tokens=False).ids
        row = got[d["doc_id"]]
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()


# --- Chat ------------------------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, formatted string"


def test_prefixes_masks_and_escapes(frame):
    odd = "</s>[INST] ok [/INST] <|end|> <\\/s> [\\\\INST] <|turn|>user\n"
    turns = frame(
        TURNS, (1, 0, "system", "s", ""), (1, 1, "user", odd, ""), (1, 2, "assistant", odd, ""), (1, 3, "user", None, ""),
        (1, 4, "assistant", "b", ""), (1, 5, "user", "last", ""), (2, None, None, "x", ""), (2, 1, "a\\n\nb<s>", "y", ""), (None, 0, "assistant", "z", ""),
    )
    made = chat.format_chat(turns)
    rows = made.select("conv_id", "example", "n_turns", "trainable", "last", chat.read_turns("formatted").alias("turns"), chat.read_loss(made).alias("loss"), "formatted")
    got = {(r["conv_id"], r["example"]): r for r in rows.collect()}
    first = [("system", "s"), ("user", odd), ("assistant", odd)]
    every = [*first, ("user", ""), ("assistant", "b"), ("user", "last")]
    assert [tuple(t) for t in got[1, 0]["turns"]] == first and got[1, 0]["loss"] == odd
    assert [tuple(t) for t in got[1, 1]["turns"]] == every[:5] and got[1, 1]["loss"] == "b"
    assert [tuple(t) for t in got[1, 2]["turns"]] == every and not got[1, 2]["trainable"] and got[1, 2]["last"]
    assert [tuple(t) for t in got[2, 0]["turns"]] == [("", "x"), ("a\\n\nb<s>", "y")] and got[2, 0]["loss"] == ""
    assert got[None, 0]["loss"] == "z" and len(got) == 5
    for row in got.values():
        assert row["formatted"].count(chat.TURN) == row["n_turns"] == row["formatted"].count(chat.END)
        assert not re.search(r"</?s>|\[/?INST\]", row["formatted"])


def test_repeated_turns_and_empty_table(frame):
    turns = frame(TURNS, (1, 0, "user", "q", ""), (1, 1, "assistant", "a", ""), (1, 1, "assistant", "a", ""))
    assert chat.format_chat(turns).count() == 2
    assert chat.format_chat(turns.limit(0)).count() == 0


def test_chat_query(spark):
    assert differences(QUERIES["op5_chat"](spark, SMALL), duck(SMALL), ORACLES["op5_chat"]) is None


# --- Language --------------------------------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    got = QUERIES["op7_language"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    right, n = got.where("held_out").select(F.sum((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    assert right / n > 0.98


def test_unknown_and_narrow(frame):
    words = {"en": "the house and the garden were green with trees ", "de": "das haus und der garten waren voller schöner bäume "}
    rows = [(i, words[k] * 8, "s", "", k) for i, k in enumerate(["en", "de"] * 6)] + [(50, "unlabelled", "s", "", None), (None, None, None, None, "en")]
    docs = frame(DOCS, *rows)
    taught = language.learned(docs)
    assert [name for name, _ in taught] == ["de", "en"]
    asked = frame(
        "doc_id long, text string, score string", (1, None, ""), (2, "", ""), (3, "123 !?", ""), (4, "der garten und das haus", ""),
        (5, "THE GARDEN, and THE HOUSE", ""), (5, "THE GARDEN, and THE HOUSE", ""), (6, words["en"] * 20_000, ""), (7, "q", ""),
    )
    made = language.identified(asked, taught)
    assert [r[1] for r in values(made.select("doc_id", "lang_pred"))] == ["und", "und", "und", "de", "en", "en", "en", "de"]
    kept = made.where(language.accepted()).select("doc_id")
    assert values(kept) == [(4,), (5,), (5,), (6,)]
    assert all(0 <= r[0] <= 1 for r in made.select("score").collect())
    assert language.identified(asked.limit(0), taught).count() == 0
    assert values(language.identified(asked, []).select("lang_pred").distinct()) == [("und",)]


def test_margins_come_from_all_labelled_rows(frame):
    words = {"en": "the house and the garden were green with trees ", "de": "das haus und der garten waren voller schöner bäume "}
    n = 3 * language.DOCS_PER_LANGUAGE
    plain = [(2 * i + k, words[lang] * 8, "s", lang, 0) for i in range(n) for k, lang in enumerate(["en", "de"])]
    both = (words["en"] + words["de"]) * 4
    columns = "doc_id long, text string, source string, lang string, n_chars long"
    sure = frame(columns, *plain)
    order = [(r["lang"], r["doc_id"]) for r in sure.orderBy(F.xxhash64(F.col("doc_id").cast("string"))).collect()]
    late = {i for lang in words for i in [i for known, i in order if known == lang][2 * language.DOCS_PER_LANGUAGE :]}
    mixed = [(i, both if i in late else text, source, lang, size) for i, text, source, lang, size in plain]
    docs = frame(columns, *mixed)
    taught = language.learned(sure)
    # Only rows behind the first 128 of each language are mixed; the least margin has to follow them.
    assert language.margins(docs, taught)[1] < language.margins(sure, taught)[1]
    without_id = frame(columns, *mixed, *[(None, both, "s", "en", 0)] * 2)
    assert len(language.margins(without_id, taught)) == 2
    assert language.margins(docs.limit(0), taught) == (language.LEAST_MARGIN,) * 2


def test_other_languages_are_rejected(spark):
    import random

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    taught = language.learned(docs.where(~held_out()))
    least = language.margins(docs.where(~held_out()), taught)
    assert language.LEAST_MARGIN < least[1]
    chance = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = [" ".join("".join(chance.choice(letters) for _ in range(chance.randrange(2, 9))) for _ in range(120)) for _ in range(200)]
    welsh = "mae hen wlad fy nhadau yn annwyl i mi gwlad beirdd a chantorion enwogion o fri ei gwrol ryfelwyr gwladgarwyr tra mad dros ryddid collasant eu gwaed "
    asked = spark.createDataFrame([(i, t) for i, t in enumerate([*noise, welsh * 3])], "doc_id long, text string")
    passed = {r["doc_id"] for r in language.identified(asked, taught).where(language.accepted(least)).collect()}
    assert len(passed) <= 20 and 200 not in passed
    left = docs.where(held_out() & (F.char_length("text") > 20))
    assert language.identified(left, taught).where(language.accepted(least)).count() >= 0.98 * left.count()


def test_classifier_against_a_plain_one(frame):
    import zstandard

    words = {"en": "the house and the garden were green with trees ", "de": "das haus und der garten waren voller schöner bäume "}
    taught = [(k, (v * 40).encode()) for k, v in words.items()]
    texts = ["The garden!", "der Garten", "Bäume, trees", "haus " * 3000]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identified(frame("doc_id long, text string", *enumerate(texts)), taught).collect()}
    for i, text in enumerate(texts):
        raw = (" " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " ").encode()
        size = {}
        for name, content in taught:
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            size[name] = sum(
                len(zstandard.ZstdCompressor(level=language.LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False).compress(raw[a : a + language.BLOCK]))
                for a in range(0, len(raw), language.BLOCK)
            )
        low, high = sorted(size.values())
        assert got[i][1] == pytest.approx((high - low) / high) and (low == high or got[i][0] == min(size, key=size.get))


# --- Quality ---------------------------------------------------------------------------------------------------------


def plain_counts(text: str) -> tuple:
    found = re.findall("[^\x20\x09-\x0d]+", text)
    windows = list(zip(*(found[i:] for i in range(5))))
    many = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    return len(found), sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)


def test_counts(frame, spark):
    given = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts = [*given[:60], None, "", " \n\t ", "a b c d e a b c d e", "x\ny\nx\n x", "é#ü \x0b<>　 |", "one two " * 30_000]
    docs = frame("doc_id long, text string, source string", *((i, t, None) for i, t in enumerate(texts)))
    got = {r["doc_id"]: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in quality.measures(docs).collect()}
    assert got == {i: plain_counts(t or "") for i, t in enumerate(texts)}
    assert quality.measures(docs.limit(0)).count() == 0


def test_host_verdicts(frame):
    good, bad = " ".join(f"w{i}" for i in range(40)), "few words"
    rows = [(i, good if i % 20 else bad, "fine") for i in range(200)] + [(1000 + i, bad if i % 10 else good, "poor") for i in range(100)]
    rows += [(2000, bad, "tiny"), (2001, good, None), (2001, good, None)]
    measured = quality.measures(frame("doc_id long, text string, source string", *rows))
    told = {r["host"]: r for r in quality.host_verdicts(measured).collect()}
    assert told["poor"]["host_failed"] and not told["fine"]["host_failed"] and not told[None]["host_failed"]
    # One failure alone is shrunk towards the prior.
    assert told["tiny"]["n_failed"] == 1 and told["tiny"]["rate"] < 0.9
    kept = quality.judged(measured, quality.host_verdicts(measured)).groupBy("source").agg(F.count("*"), F.sum(F.col("kept").cast("int")))
    assert set(values(kept)) == {("fine", 200, 190), ("poor", 100, 0), ("tiny", 1, 0), (None, 2, 2)}
    none = measured.limit(0)
    assert quality.judged(none, quality.host_verdicts(none)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), duck(SMALL), ORACLES[name]) is None
