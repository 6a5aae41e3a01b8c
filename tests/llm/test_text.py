"""Words, quality rules, main text and language identification."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowtide.llm import html_main, language, quality, words
from tests.llm.samples import near_copies, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abA é  \n\t\x1c|.", max_size=40)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([3, 7, 1 << 20]))
def test_words_equal_the_pattern(texts, slice_bytes):
    kept, words.SLICE = words.SLICE, slice_bytes
    try:
        found = words.split_words(pa.array(texts, pa.string()))
        lower = words.split_words(pa.array(texts, pa.string()), lower=True)
    finally:
        words.SLICE = kept
    own = [found.data[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends)]
    expected = [WORD.findall(t or "") for t in texts]
    assert own == [w for t in expected for w in t]
    assert np.diff(found.first).tolist() == [len(t) for t in expected]
    assert len(set(found.hashes.tolist())) == len(set(own))
    folded = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in own]
    assert len(set(lower.hashes.tolist())) == len(set(folded))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=60), max_size=5), st.sampled_from([1, 2, 5, 9, 20]))
def test_window_hashes(texts, n):
    found = words.split_words(pa.array(texts, pa.string()))
    at, hashes = found.windows(n)
    expected = [tuple(w[i:i + n]) for w in (t.split() for t in texts) for i in range(len(w) - n + 1)]
    assert len(at) == len(expected)
    assert len(set(zip(hashes.tolist(), expected))) == len(set(expected)) == len(set(hashes.tolist()))


def ends(line):
    while line and line[-1] in quality.SPACES:
        line = line[:-1]
    while line and line[-1] in quality.CLOSERS:
        line = line[:-1]
    return line != "" and line[-1] in quality.LATIN_ENDERS + quality.OTHER_ENDERS


def finished(line, k):
    """Whether a sentence is over with the character at k."""
    if line[k] in quality.OTHER_ENDERS:
        return True
    if line[k] not in quality.SPACES:
        return False
    k -= 1
    while k >= 0 and line[k] in quality.LATIN_CLOSERS:
        k -= 1
    end = k
    while k >= 0 and line[k] in quality.LATIN_ENDERS:
        k -= 1
    return 0 <= k < end and line[k].isalnum()


def brute_quality(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    lines, dup, failed, lost = text.split("\n"), 0, 0, 0
    for i, line in enumerate(lines):
        own = WORD.findall(line)
        if not own:
            continue
        dup += line in lines[:i]
        low = re.sub("[A-Z]", lambda m: m[0].lower(), line)
        phrases = len(re.findall("|".join(rf"\b{p}s?\b" for p in quality.PHRASES), low))
        bad = (not ends(line) and (len(own) < 10 or not any(finished(line, k) for k in range(len(line))))
               or len(own) <= 15 * phrases
               or 10 * sum(c in quality.SYMBOLS for c in line) > 3 * len(own)
               or 5 * sum(x in quality.SEPARATORS for x in own) >= len(own))
        failed += bad
        lost += bad * len(own)
    base = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in text), dup, len(hit), failed, lost, base,
            not base and 100 * lost <= 50 * len(w))


AWKWARD = ["", " ", "\n\n", "One line.\nOne line.\nno end\n \nOne line.", "a b c d e. " * 9, "é è ü ß ñ — “q.” x. " * 3,
           "Home | About | Contact | Imprint |\n" + "Real text stands here and it goes on. " * 2, "x" * 5000 + ".",
           "The first sentence has ended. The second of this paragraph has ended too. A third one follows", "no. end of it " * 5,
           "Sign up, log in. Log in sign up click here: " + "words go on and on here " * 9 + ".", "यह एक लंबा वाक्य है जो कई शब्दों में लिखा गया है।",
           "Each catalog in the dialog in here is a page_cookie of javascripts, or a cookie.", "这里有一句话。 后面 还 有 一些 词 没有 说 完 的 话 和 字",
           "He said “it is done.” and then went on to a place far away from there", "x_. y __. z a b c d e f g h i j k",
           "We use COOKIES here.\nThis line has ten words in it, or even some more.", "# $ % & | < > *", "\x1ca b\x1fc.\r\nd e f g h i j k l m.\x0b"]


def test_quality_equals_brute_force(spark):
    texts = AWKWARD + [t for _, t in near_copies()]
    rows = list(enumerate(texts))
    found = {r["doc_id"]: tuple(r)[1:] for r in quality.judge(table(spark, rows)).collect()}
    for d, text in rows:
        assert found[d] == brute_quality(text), text


def test_clean_keeps_what_judge_keeps(spark):
    rows = list(enumerate(AWKWARD + [t for _, t in near_copies()]))
    kept = [r["doc_id"] for r in quality.judge(table(spark, rows)).filter("kept").collect()]
    assert sorted(kept) == sorted(r["doc_id"] for r in quality.clean(table(spark, rows)).collect()) and len(kept) > 5


def test_sql_states_the_rules(spark):
    import duckdb

    from flowtide.llm.quality_sql import QUALITY_SQL
    rows = list(enumerate(AWKWARD))
    documents = pa.table({"doc_id": [d for d, _ in rows], "text": [t for _, t in rows]})  # noqa: F841  read by name
    told = {r[0]: r[1:] for r in duckdb.sql(QUALITY_SQL).fetchall()}
    assert told == {d: brute_quality(t) for d, t in rows}


def test_clean_keeps_columns_and_good_lines(spark):
    good = "This is a fine line with words in it.\nAnd a second one that ends well."
    rows = [(1, good + "\nMenu | Home | About |"), (2, "Menu | Home | About |"), (None, good), (4, None), (1, good)]
    docs = spark.createDataFrame([(d, t, 7, "w") for d, t in rows], "doc_id long, text string, n_chars long, kept string")
    out = sorted(quality.clean(docs).collect(), key=str)
    assert {(r["doc_id"], r["text"], r["n_chars"], r["kept"]) for r in out} == {(1, good, len(good), "w"), (None, good, len(good), "w")}
    assert len(out) == 3 and quality.clean(docs.limit(0)).count() == 0


def test_clean_keeps_paragraphs_without_a_last_mark(spark):
    prose = "The first sentence has ended. The second one of this paragraph has ended too. A third one follows"
    hindi = "यह एक लंबा वाक्य है जो कई शब्दों में लिखा गया है।"
    rows = [(1, prose), (2, hindi), (3, "No sentence of this long line of words has come to its end yet"),
            (4, prose + "\nHome. About"), (5, hindi + " दूसरा वाक्य अभी चल रहा")]
    found = {r["doc_id"]: r["text"] for r in quality.clean(table(spark, rows)).collect()}
    assert found == {1: prose, 2: hindi, 4: prose, 5: rows[4][1]}


def test_clean_keeps_lines_that_a_phrase_does_not_dominate(spark):
    recipe = "Stir the dough and bake each cookie for ten minutes. " + " ".join(f"w{i}" for i in range(30)) + "."
    border = "Every entry of the catalog in this library has a dialog in three languages for visitors."
    menu = recipe + "\nWe use Cookies here. Click here or read more about them."
    found = {r["doc_id"]: r["text"] for r in quality.clean(table(spark, [(1, recipe), (2, border), (3, menu), (
        4, "We use cookies on all pages of this site, so please accept them.")])).collect()}
    assert found == {1: recipe, 2: border, 3: recipe}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script></head>
<body><header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We care</div>
<div class="layout"><aside>Side words here</aside><article><header>By someone</header><h1>Head &amp; shoulders</h1>
<p>First <b>bold</b>word&nbsp;and <a href=x>link</a>.<p>Second
 line<br>third<div class="ad">Buy now</div><form>Mail <input></form><table><tr><td>cell one<td>cell two</table>
<p class="notice">Mind the <b>gap</b><p><span class="share-links">Tweet</span>Last <a class=more>words</a></p>
<div class="comments"><p>Nice post, really nice</p></div></article></div><footer>&copy; all</footer></body></html>"""


def test_main_text(spark):
    pages = spark.createDataFrame(
        [(i, f"u{i}", PAGE.replace("Head", f"Head{i}"), "x") for i in range(20)] + [(90, None, None, "x"), (91, "u", "", "x"),
         (92, "u", "<p>only words here", "x"), (None, "u", "<nav>menu</nav><b", "x")],
        "page_id long, url string, html string, text string")
    found = {r["page_id"]: r for r in html_main.extract(pages, html_main.fit(pages)).collect()}
    assert found[3]["text"] == "Head3 & shoulders First boldword and link. Second line third cell one cell two Last words"
    assert found[3]["n_chars"] == len(found[3]["text"])
    assert (found[90]["text"], found[91]["text"], found[92]["text"], found[None]["text"]) == ("", "", "only words here", "")
    assert html_main.extract(pages.limit(0), html_main.Weights()).count() == 0


STORY = "<article><h1>News of the long day</h1><p>Ten plain words make up the text of this story.</p></article>"
TOLD = "News of the long day Ten plain words make up the text of this story."


@pytest.mark.parametrize("marks", ["layout no-sidebar", "content has-sidebar", "side-by-side", "post comment-open", "sidebar",
                                   "widget-area", "social"])
def test_wrappers_of_the_article_stay(marks):
    for story, told in ((STORY, TOLD), (STORY.replace("article", "section"), TOLD)):
        page = f'<html><head><title>T</title></head><body><div class="{marks}">{story}<div class="ad">Buy now</div></div></body>'
        assert html_main.main_text(page, html_main.Weights()) == told
    assert html_main.main_text(f'<form id="f">{STORY}</form>', html_main.Weights()) == TOLD


def test_notices_beside_the_article_go():
    others = ('<div class="cookie-notice">We care</div><div class="related">Other news</div><div id="comments-list">'
              '<article class="comment">Nice</article></div><div class="sidebar-primary widget-2">More</div><form>Mail</form>')
    assert html_main.main_text(STORY + others, html_main.Weights()) == TOLD


@pytest.mark.parametrize("start", ["<body>", "<div>", "", "<noscript>x</noscript><main>", "Words stand bare before it. "])
def test_a_head_without_an_end(start):
    page = f"<html><head><meta charset=utf-8><title>Title of it</title><script>var a</script>{start}{STORY}"
    assert html_main.main_text(page, html_main.Weights()) == ("" if "<" in start else start) + TOLD


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-5, 5).map(float), max_size=12))
def test_best_run_is_the_best(scores):
    low, high = html_main.best_run(scores)
    best = max([0.0] + [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)])
    assert sum(scores[low:high]) == best


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100 and np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    rng = random.Random(1)
    say = {"aa": "ba be bi bo", "zz": "xun xen qin qon"}
    rows = [(i, " ".join(rng.choice(say[k].split()) for _ in range(30)), k) for i, k in enumerate(list(say) * 30)]
    odd = [(1001, None, "aa"), (1002, "", "aa"), (1003, "12 34 !?", None), (1004, "Ba be bi", None), (None, "XUN xen", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs).collect()}
    assert [found[d][0] for d in (1001, 1002, 1003, 1004, None)] == ["und", "und", "und", "aa", "zz"]
    assert found[1001][1] == 0 and all(found[i][0] == k for i, _, k in rows)
    assert language.identify(docs.limit(0)).count() == 0
    untrained = language.identify(docs.withColumn("lang", docs["lang"].substr(9, 0)).filter("lang is null")).collect()
    assert {r["lang_pred"] for r in untrained} == {"und"}


@pytest.mark.parametrize("k", [1, 3])
def test_clusters_find_separate_points(k):
    points = np.eye(3, dtype=np.float32)[[0, 0, 1, 1, 2]]
    centres, limits = language.clusters(points, k, 5, 0.0)
    assert len(centres) == k and (k < 3 or np.allclose(limits, 1))


def thue_morse(n: int) -> tuple[str, str]:
    """The sequence over a and b, and its complement: equal under any polynomial hash modulo 2^64 from n = 1,024 on."""
    first = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return first, first.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [64, 1024, 4096, 1 << 15])
@pytest.mark.parametrize("lower", [False, True])
def test_structured_words_differ(n, lower):
    a, b = thue_morse(n)
    for pair in ((a, b), (a + "x" * 7, b + "x" * 7), ("é" + a, "é" + b)):
        found = words.split_words(pa.array([f"w {pair[0]} {pair[1]} {pair[0]}", pair[0], pair[1]]), lower=lower)
        left, right = found.hashes[1], found.hashes[2]
        assert left != right and found.hashes[3] == left and found.hashes[4] == left and found.hashes[5] == right


def test_equal_words_have_equal_hashes_wherever_they_stand(monkeypatch):
    rng = random.Random(4)
    pool = ["".join(rng.choices("abcé", k=rng.randrange(1, 40))) for _ in range(200)]
    text = " ".join(rng.choices(pool, k=5000))
    monkeypatch.setattr(words, "SLICE", 4096)
    found = words.split_words(pa.array([text]))
    seen = {}
    for word, value in zip(text.split(" "), found.hashes.tolist()):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_a_word_longer_than_all_slices():
    word = "ab" * (5 << 20)
    found = words.split_words(pa.array([f"x {word} y {word}z {word}"]))
    assert found.hashes[1] == found.hashes[4] != found.hashes[3]


@pytest.mark.parametrize("piece", ['<h2 class="section-header">one two</h2>', '<p class="legal">one two</p>', '<div class="side">one two</div>',
                                   'so <span class="notice">one two</span> so', "<label>one two</label>",
                                   '<p data-role="social">one two</p>', '<div data-id="share">one two</div>'])
def test_names_do_not_drop_the_text_of_an_article(piece):
    page = f"<html><body><nav>menu</nav><article><p>{'word ' * 30}</p>{piece}<p>{'word ' * 30}</p></article></body></html>"
    assert "one two" in html_main.main_text(page, html_main.Weights())


@pytest.mark.parametrize("piece", ['<div class="notice">one two</div>', '<div class="ad">one two</div>', "<aside>one two</aside>",
                                   '<span class="share">one two</span>', "<form><label>one two</label></form>"])
def test_what_is_no_content_goes(piece):
    page = f"<html><body><article><p>{'word ' * 30}</p>{piece}<p>{'word ' * 30}</p></article></body></html>"
    assert html_main.main_text(page, html_main.Weights()).split() == ["word"] * 60


def test_a_long_aside_does_not_cut_an_article():
    page = f"<article><p>{'a ' * 40}</p><aside>{'x ' * 500}</aside><p>{'b ' * 40}</p></article>"
    assert html_main.main_text(page, html_main.Weights()).split() == ["a"] * 40 + ["b"] * 40


@pytest.mark.parametrize("piece", ["<a ", "<a x=\"", "<a x='\"", "<label>", "<span class=ad>", "<div>", "</nav>", "<script>", "<!--",
                                   "<div></nav>", "<p class=ad>x"])
def test_hostile_pages_take_linear_time(piece):
    import time

    start = time.perf_counter()
    html_main.main_text(piece * (200_000 // len(piece)), html_main.Weights())
    assert time.perf_counter() - start < 3


def slow_text(page):
    """The article's blocks by plain string work, for pages made of the parts below."""
    inside = page.partition("<article>")[2].partition("</article>")[0]
    inside = re.sub(r"(?s)<(aside|nav|footer|script|form)>.*?</\1>|<div class=\"(?:ad|notice|share-box)\">.*?</div>", " ", inside)
    inside = re.sub(r"</?(?:b|i|a)>", "", inside)
    text = re.sub(r"<[^>]*>", " ", inside)
    for mark, char in (("&lt;", "<"), ("&eacute;", "é"), ("&#65;", "A"), ("&amp;", "&")):
        text = text.replace(mark, char)
    return " ".join(text.split())


def test_generated_pages_against_a_plain_version():
    rng = random.Random(21)
    word = lambda: rng.choice(["alpha", "beta", "g&eacute;", "&#65;b", "a&amp;b", "<b>bold</b>", "x<i>y</i>", "1 &lt; 2"])
    para = lambda: f"<p>{' '.join(word() for _ in range(rng.randrange(5, 40)))}</p>"
    other = lambda: rng.choice([
        "<aside>{}</aside>", "<nav>{}</nav>", "<script>{}</script>", "<form>{}</form>", '<div class="ad">{}</div>',
        '<div class="notice">{}</div>', '<div class="share-box">{}</div>']).format("noise " * rng.randrange(1, 30))
    for _ in range(200):
        body = "".join(rng.choice([para, para, other])() for _ in range(rng.randrange(3, 12))) + para()
        page = (f"<html><head><title>t</title></head><body><nav>{'m ' * 5}</nav>{other()}<article>{para()}{body}</article>"
                f"{other()}<footer>{'f ' * 9}</footer></body></html>")
        learned = {"w:article": 4.0, "w:body": -4.0} | {f"t:{c}{n}": -0.05 for n in ("p", "b", "i", "article") for c in ("", "/")}
        assert html_main.main_text(page, html_main.Weights(learned)) == slow_text(page), page
