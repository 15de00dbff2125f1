import random
from itertools import product

from pricetide.llm.html_extraction import extract_pages, main_text, min_cut

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body class="has-sidebar"><!-- <p>hidden</p> --><header><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a>
<li><a href="/b>c">News</a></ul></nav><div class="ad">Buy this wonderful thing today, it is really very good indeed.</div>
<article><header><h1>The &quot;title&quot;</h1></header><p><b>First   paragraph,&nbsp;with
a <a href=x>link</a> in it.<br><p>Short.<p>A longer one &lt;tag&gt; &eacute;&#233; that goes on.</p>
<div class="share">Share this on every network you know</div><blockquote><p>Quoted words stay.</p></blockquote>
<form action=x><label>Your name</label><input><textarea>nothing</textarea></form></article>
<aside>Related things that somebody thought you may want to read as well. Yes.</aside>
<section id="comments"><p>I agree with everything that was said in this article, great work.</p></section>
<div class="cookie-notice">We use cookies. Please accept all of them now.</div>
<footer>&copy; 2020 <p>All rights reserved</footer>"""


def test_article_only():
    assert main_text(PAGE) == "\n".join([
        'The "title"', "First paragraph, with a link in it.", "Short.", "A longer one <tag> éé that goes on.",
        "Quoted words stay."])


def test_page_without_marks():
    text = "Words enough to be the content of a page, with a full stop at the end."
    page = f"<body><a href=1>One</a> <a href=2>Two</a><div>{text}</div><div>{text}</div><p>Subscribe to our newsletter</p>"
    assert main_text(page) == f"{text}\n{text}"


def test_cut_is_minimal():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 8)
        scores = [rng.choice([-3, -1.5, -0.5, 0.25, 0.75, 2]) + rng.random() / 8 for _ in range(n)]
        edges = [(i, j, rng.random() * 2) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(label):
            return sum(max(s, 0) if not x else max(-s, 0) for s, x in zip(scores, label)) + sum(
                c for i, j, c in edges if label[i] != label[j])
        best = min(cost(x) for x in product([False, True], repeat=n))
        assert abs(cost(min_cut(scores, edges)) - best) < 1e-6


def test_odd_rows_and_columns(spark):
    rows = [(1, None, "u"), (2, "", "u"), (3, "<nav><li>menu", "u"), (4, "plain text without any tag that is fine.", "u"),
            (5, "<article><p>" + "word " * 50000, "u"), (5, "<article><p>" + "word " * 50000, "u"),
            (6, "<p>a < b and c > d are fine for a paragraph that is long enough.", "u"), (7, "<!-- never ends", "u"),
            (8, "<div><div><div>" * 3000 + "<p>A paragraph far down, but with words in it.</p>", "u")]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, html string, text string"))
    assert got.columns == ["page_id", "text", "n_chars"]
    found = {r.page_id: r.text for r in got.collect()}
    assert [found[i] for i in (1, 2, 3, 7)] == [""] * 4
    assert found[4] == rows[3][1] and found[5] == "word " * 49999 + "word"
    assert found[6].startswith("a < b and c > d") and found[8].startswith("A paragraph far down")
    assert got.count() == len(rows) and all(r.n_chars == len(r.text) for r in got.collect())
    assert extract_pages(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_drawings_and_formulas_leave_the_article():
    one = "One is a sentence that is long enough to be read as the content of a page, is it not."
    two = one.replace("One", "Two")
    for mark in ('<svg class="i"/>', "<math/>", "<svg><path d='M0'/><text>no</text></svg>", "<svg><svg>no</svg>no</svg>",
                 "<select><option>no</select>", "<template><p>no</template>", "<object>", "<svg>", "<SVG viewBox='0' />"):
        assert main_text(f"<article><p>{one}</p>{mark}<p>{two}</p></article>") == f"{one}\n{two}", mark
    formula = ("<math><semantics><mrow><mi>a</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding='tex'>no</annotation>"
               "</semantics></math>")
    assert main_text(f"<article><p>{one} {formula} holds <svg/>here.</p></article>") == f"{one} a=2 holds here."


SENTENCES = "Words enough to be the content of a page, with a full stop at the end. And one more sentence of them."


def test_only_attributes_hide():
    def text_of(start):
        return main_text(f"<html><body><article>{start}{SENTENCES}</p></article></body></html>")

    for start in ('<p title="The hidden cost">', '<p style="overflow: hidden ;">', '<p data-x=hidden>', '<p class="x" alt="a hidden b">',
                  '<p title="display:none">'):
        assert SENTENCES in text_of(start), start
    for start in ("<p hidden>", '<p class="x" HIDDEN="">', '<p style="color:red; display : none">', "<p style=display:none>"):
        assert SENTENCES not in text_of(start), start
