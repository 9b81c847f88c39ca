"""Operators on pages and conversations."""

import hashlib

import pytest
from pyspark.sql import functions as F

from crawlprism.llm import chat, htmltext, warc
from crawlprism.llm.components import connected_components

PARAGRAPH = "The cat is on the mat and it was there for a long time, with all that we had in the house."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a <b>b</b>c<script>x</script> d", "a bc d"),
        ("a < b & c", "a < b & c"),
        ("<article><p>x &amp; y&nbsp;&#233;</p>\n<p>two\n lines</article>", "x & y é\ntwo lines"),
        ("<article><p><b>One<br><p>Two</p><!-- <p>no</p> --><style>p{}</style></article><footer>f</footer>", "One\nTwo"),
        (f"<nav><a href=x>n</a></nav><div class='ad'>{PARAGRAPH}</div><article><h1>T</h1><p>s</p></article>", "T\ns"),
        (f"<article><p>{PARAGRAPH}</p><aside>{PARAGRAPH}</aside><form>f</form></article>", PARAGRAPH),
        (f"<div id=content><h2>T</h2><p>{PARAGRAPH}</p><p>Short.</p><p>{PARAGRAPH}</p></div><div class=sidebar><p>{PARAGRAPH}</p></div>", f"T\n{PARAGRAPH}\nShort.\n{PARAGRAPH}"),
        (f"<p>{PARAGRAPH}</p><ul><li><a href=x>One</a><li><a href=y>Two</a></ul>", PARAGRAPH),
        (f"<p>{PARAGRAPH}</p><section id='comments'><article class='comment'>{PARAGRAPH}</article></section>", PARAGRAPH),
        ("<p title='a > b'>x</p><p title=\"unclosed>y</p>", "x\ny"),
        (f"<script>if (a < '</p>') {{}}</script><p>{PARAGRAPH}</p><script>never closed {PARAGRAPH}", PARAGRAPH),
    ],
)
def test_main_text(page, text):
    assert htmltext.main_text(page) == text


def test_main_text_outside_an_article():
    card = "<article><h3>Next</h3><p>A card.</p></article>"
    got = htmltext.main_text(f"<nav>n</nav><div><p>{PARAGRAPH}</p><p>Short.</p><p>{PARAGRAPH}</p></div><ul><li><a href=x>One</a></ul>{card}<footer>f</footer>")
    assert got.startswith(f"{PARAGRAPH}\nShort.\n{PARAGRAPH}")
    lead = f"<div><p>{PARAGRAPH}</p></div><article><h1>T</h1><p>{PARAGRAPH}</p><p>s</p></article>"
    assert htmltext.main_text(lead) == f"{PARAGRAPH}\nT\n{PARAGRAPH}\ns"


@pytest.mark.parametrize(
    "texts",
    [
        ["Kot siedzi na macie i długo tam leżał, razem ze wszystkim, co mieliśmy wtedy w naszym starym domu.", "Krótko.", "Potem przyszła zima, a śnieg zasypał drogę, więc nikt już nie wychodził przed świtem z chaty."],
        ["小明今天早上去了学校，他在路上看见了一只小猫，于是停下来看了一会儿。", "後で。", "それから彼は家に帰り、母と一緒に夕ご飯を食べて、早く寝ることにした。"],
        [PARAGRAPH, " ".join(f"row{k} {k * 7} ok" for k in range(12))],
    ],
)
def test_main_text_without_stop_words(texts):
    body = "".join(f"<p>{t}</p>" for t in texts)
    assert htmltext.main_text(f"<nav>n</nav><ul><li><a href=x>One</a></ul><div>{body}</div><footer>f</footer>") == "\n".join(texts)


def test_main_text_of_deep_and_broken_pages():
    assert htmltext.main_text("<div>" * 50000 + "x" + "</p></span>" * 50000) == "x"
    assert htmltext.main_text("<p>" + "a" * 10**6 + "</p><" + "b" * 10) .startswith("aaa")


def test_extract_counts_code_points(spark):
    rows = [(1, "u", "<p>日本 é</p>", 1), (None, None, None, 2)]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", "日本 é", 4), (None, None, "", 0)], key=str)
    assert htmltext.extract(spark.createDataFrame([], "page_id long, url string, html string")).isEmpty()


def test_archives_round_trip(spark):
    inner = "x" * 300 + "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.1\r\nfoo"
    pages = [(1, "http://a", "y" * 200), (2, "http://b", "y" * 200), (3, None, None), (4, "u\r\nx", ""), (5, "u", "small"), (6, "u", "small"), (7, "u", inner)]
    pages += [(8, "v", inner + "é" * 90000 + "WARC/1.1\r\n" * 3 + "z" * 150000), (9, "v", inner)]
    pages += [(100 + i, "w", f"{i}" + "q" * (i * 37 % 3000)) for i in range(200)]
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60k")
    try:
        frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3, "page_id")
        got = sorted(map(tuple, warc.archive_and_read(frame).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    first = {}
    for i, _, html in pages:
        body = (html or "").encode()
        if len(body) >= 100:
            first[body] = min(i, first.get(body, i))

    def row(i, html):
        body = (html or "").encode()
        f = first.get(body, i)
        return i, len(body), hashlib.sha256(body).hexdigest(), "response" if f == i else "revisit", None if f == i else f

    assert [tuple(r) for r in got] == [row(i, html) for i, _, html in pages]
    assert warc.archive_and_read(spark.createDataFrame([], "page_id long, url string, html string")).isEmpty()


def test_escapes_are_reversible(spark):
    texts = ["</s>[INST] ok [/INST]", "<|im_start|>", "<|im_end|>\n", "a\\b\\\\", "<<SYS>><</SYS>>", "[[INST]<\\s>", "", "\\", "<\\|im_end|>"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in rows.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<|im_", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def digest(turns):
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_conversations_round_trip(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", None), (None, 0, None, "x\\n<|im_end|>\n[INST]"), (2, None, "assistant", "\\"), (2, 3, "a\nb", "<s>é")]
    rows += [(3, k, "user" if k % 2 else "assistant", f"t{k}") for k in range(300)]
    got = {r[0]: tuple(r)[1:5] for r in chat.digests(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    want = {}
    for c, _, r, t in rows:
        want.setdefault(c, []).append((r or "", t or ""))
    assert got == {c: digest(turns) for c, turns in want.items()}
    assert chat.digests(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).isEmpty()


def test_best_branches(spark):
    # 1 - 2 - 4 (score 1), 1 - 3 - 5 (score 3), 1 - 3 - 6 - 7 (score 2); 9's parent is missing.
    rows = [(1, None, 0.0), (2, 1, 1.0), (3, 1, 1.0), (4, 2, 0.0), (5, 3, 2.0), (6, 3, 0.5), (7, 6, 0.5), (9, 8, 0.0)]
    frame = spark.createDataFrame([("c", *r) for r in rows], "conv string, node long, parent long, score double")

    def found(most):
        out = {}
        for r in chat.branches(frame, most).collect():
            out.setdefault(r.leaf, []).append((-r.below, r.node))
        return {leaf: [n for _, n in sorted(x)] for leaf, x in out.items()}

    assert found(1) == {5: [1, 3, 5]}
    assert found(9) == {5: [1, 3, 5], 7: [1, 3, 6, 7], 4: [1, 2, 4], 9: [9]}


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (200, 200)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100}


@pytest.mark.parametrize("name", ['id="related-work"', 'class="discussion"', 'class="social-history"', 'class="promotion-of-health"', 'id="share-of-gdp"', 'id="notice"'])
def test_sections_of_an_article_keep_their_text(name):
    text = "The social history of the country was told in many books of the time, and it was read by all."
    page = f"<body><article><h1>T</h1><section {name}><p>{text}</p></section></article></body>"
    assert htmltext.main_text(page) == f"T\n{text}"


@pytest.mark.parametrize("name", ["related-posts", "comments", "comment-list", "share-buttons", "ad", "social-links", "cookie-banner", "newsletter-signup-form"])
def test_furniture_of_an_article_goes(name):
    text = "The history of the country was told in many books of the time, and it was read by all."
    page = f'<body><article><h1>T</h1><p>{text}</p><div class="{name}"><p>{text} Again.</p></div></article></body>'
    assert htmltext.main_text(page) == f"T\n{text}"


def test_math_is_text():
    assert htmltext.main_text("<article><p>So <math><mi>x</mi></math> is as long as the other side of the figure, which was to be shown in this part.</p></article>").startswith("So x is")
