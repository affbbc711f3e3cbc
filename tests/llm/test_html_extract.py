import random
from collections import Counter

import pytest

from foldwise.llm import html_extract as hx

PRIOR = hx.Weights(Counter(), Counter())
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style><script>var a="</p><p>words words";</script></head>
<body class="has-sidebar"><header><h1>Site name</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><div id="cookie-notice">We use cookies here always</div>
<main><article><h1>Title &amp; more</h1><p>First para\n  with <b>several</b> words&nbsp;in it.</p><aside>Other things</aside><!-- c <p>no</p> -->
<p>Second para<br>line two &lt;b&gt; x < y &#233;</p><form><label>Subscribe now</label></form><ul><li>item one</li><li>item two</li></ul>
<div class="ad">Buy this</div><section class="comments"><p>I like this very much thanks for the great content</p></section></article></main>
<footer>&copy; site words words words</footer></body></html>"""


def test_article_only():
    assert hx.main_text(PAGE, PRIOR).split("\n\n") == [
        "Title & more", "First para with several words in it.", "Second para line two <b> x < y é", "item one", "item two"]


@pytest.mark.parametrize("page,text", [(None, ""), ("", ""), ("<nav>menu only</nav>", ""), ("plain words", "plain words"), ("<p>a<p>b", "a\n\nb"),
                                       ("<p>kept<!-- open comment", "kept"), ("<article><nav>x<article>words here</article>", "words here"), ("<<>>", "<<>>")])
def test_edges(page, text):
    assert hx.main_text(page, PRIOR) == text


def test_best_region_against_all_regions():
    rng = random.Random(2)
    for _ in range(300):
        scores = [rng.choice([-2.0, -1.0, 0.0, 1.0, 2.0]) for _ in range(rng.randint(0, 12))]
        a, b = hx.best_region(scores)
        best = max([0.0, *[sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]])
        assert sum(scores[a:b]) == best


def test_labelled_pages_and_weights(spark, sf_dir):
    from foldwise.llm.common import documents, table
    pages = table(spark, sf_dir, "pages")
    labelled = hx.labelled_pages(pages, documents(spark, sf_dir), 50).collect()
    assert 0 < len(labelled) <= 50
    weights = hx.fit(spark.createDataFrame(labelled))
    assert weights.word["block", "p"] > 0 > weights.word["link", True] and all(v < 0 for v in weights.tags.values())
    for r in labelled:
        want = [x for x in map(hx.squeeze, r["lines"]) if x]
        assert hx.main_text(r["html"], weights).split("\n\n")[1:] == want  # behind the heading


def test_frame(spark):
    rows = [(1, "u", "<p>one two</p>"), (1, "u", "<p>one two</p>"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(map(tuple, hx.extract(pages, PRIOR, ["page_id", "url"]).collect()), key=str)
    assert got == [(1, "u", "one two", 7), (1, "u", "one two", 7), (None, None, "", 0)]
    assert hx.extract(pages.limit(0), hx.fit(spark.createDataFrame([], "html string, lines array<string>")), ["page_id"]).count() == 0
    with pytest.raises(ValueError):
        hx.extract(pages.withColumnRenamed("url", "text"), PRIOR, ["text"])


WORDS = "<p>First words of the article stand here</p><p>and some more words follow them here</p>"
TEXT = ["First words of the article stand here", "and some more words follow them here"]


@pytest.mark.parametrize("begin,end", [('<div class="page has-sidebar">', "</div>"), ('<div id="post-with-comments">', "</div>"), ("<form action=x>", "</form>"),
                                       ('<div class="page has-sidebar"><form id=aspnet><div class="no-banner">', "</div></form></div>")])
def test_wrappers_that_hint_at_exclusions_are_read(begin, end):
    parts = '<div class="sidebar"><p>Other stories of the day and of the week to read now</p></div><aside>short note</aside><div class="left-menu">A B</div>'
    assert hx.main_text(f"<body>{begin}{WORDS}{end}</body>", PRIOR).split("\n\n") == TEXT
    assert hx.main_text(f"<body><nav>a b c</nav>{begin}{parts}<div>{WORDS}</div>{parts}{end}<footer>x</footer></body>", PRIOR).split("\n\n") == TEXT


@pytest.mark.parametrize("tag", ["header", 'div class="entry-header"'])
def test_headings_of_the_articles_header_stay(tag):
    head = f"<{tag}><h1>The title <b>itself</b></h1><p>By someone</p></{tag.split()[0]}>"
    assert hx.main_text(f"<body>{head}<article>{head}{WORDS}</article></body>", PRIOR).split("\n\n") == ["The title itself", *TEXT]


def test_small_doubtful_parts_are_left_out():
    page = f'<body><div class="post-comments">I like it</div><div>{WORDS}</div><div class="site-menu">one two</div></body>'
    assert hx.main_text(page, PRIOR).split("\n\n") == TEXT


@pytest.mark.parametrize("sizes", [(43, 40), (40, 40), (8, 300)])
def test_every_column_of_a_page_is_read(sizes):
    """Columns in equal wrappers that hint at a sidebar, whatever their shares of the words."""
    columns = [f"Column {i} " + " ".join(f"word{j}" for j in range(n)) + "." for i, n in enumerate(sizes)]
    page = "<body>" + "".join(f'<div class="page has-sidebar"><p>{c}</p></div>' for c in columns) + "</body>"
    assert hx.main_text(page, PRIOR).split("\n\n") == columns


def test_unmarked_menus_and_footers():
    menu = "<div><a href=/a>Home</a> <a href=/b>World news</a> <a href=/c>Sport</a></div><ul><li><a href=/d>About us</a></li><li><a href=/e>Contact</a></li></ul>"
    page = f"<body>{menu}<div>{WORDS}</div><div>\u00a9 2024 Example. All rights reserved</div>{menu}</body>"
    assert hx.main_text(page, PRIOR).split("\n\n") == TEXT


def test_long_comments_inside_an_article_are_stepped_over():
    talk = "".join(f"<p>Reader {i} says that this is a very long comment on the article, and goes on for a while after that.</p>" for i in range(40))
    page = f'<body><article>{WORDS}<section class="comments">{talk}</section>{WORDS}</article></body>'
    assert hx.main_text(page, PRIOR).split("\n\n") == TEXT + TEXT


def bared(page):
    """The page without any mark-up that says what a part is."""
    for tag in ("nav", "footer", "header", "aside", "article", "main"):
        page = page.replace(f"<{tag}>", "<div>").replace(f"</{tag}>", "</div>")
    return page.replace(' class="ad"', "")


def test_the_scan_alone_finds_the_article(spark, monkeypatch):
    """No listed name or tag, menus, adverts and footers in plain divs: weights from 50 such
    pages, judged on the words of the others.  Recall and precision of the article's lines."""
    from foldwise.llm.common import documents, table
    monkeypatch.setattr(hx, "EXCLUDED_NAMES", frozenset())
    monkeypatch.setattr(hx, "EXCLUDED_TAGS", frozenset())
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r["page_id"], bared(r["html"]), r["lines"]) for r in hx.labelled_pages(table(spark, sf_dir, "pages"), documents(spark, sf_dir), 250).collect()]
    learn, judge = rows[:50], rows[50:]
    sides = Counter(), Counter()
    for _, page, lines in learn:
        for total, part in zip(sides, hx.token_counts(page, {hx.squeeze(x) for x in lines} - {""})):
            total.update(part)
    weights = hx.Weights(*sides)
    hit = found = wanted = left_out = 0
    for _, page, lines in judge:
        want = Counter(w for x in lines for w in hx.squeeze(x).split())
        got = Counter(w for x in hx.main_text(page, weights).split("\n\n")[1:] for w in x.split())  # behind the heading
        hit, found, wanted = hit + (want & got).total(), found + got.total(), wanted + want.total()
        left_out += sum(x.words for x in hx._flat(hx.parse(page)) if isinstance(x, hx.Block)) - got.total()
    assert len(judge) >= 150 and left_out > 0.05 * wanted  # there is something to leave out
    assert hit / wanted > 0.98 and hit / found > 0.98, (hit / wanted, hit / found)


def test_regions_against_all_choices():
    """The nested scan equals a search over every region of every level, on small pages."""
    rng = random.Random(5)
    parts = ["<p>one two three four.</p>", "<div>a b</div>", '<div class="x-menu">', "</div>", "<ul><li>x</li></ul>", "<a>l m n</a>", "<nav>", "</nav>", "<h2>t u</h2>"]
    for _ in range(200):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(1, 8)))
        root = hx.parse(page)
        cost = -PRIOR.of_tag("excluded")

        def value(e):
            scores = [PRIOR.of_tag(x) if isinstance(x, str) else PRIOR.of_block(x) if isinstance(x, hx.Block) else max(value(x) - cost, -cost) for x in e.content]
            return max([0.0, *[sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]])
        hx.scan(root, PRIOR)
        assert abs(root.score - value(root)) < 1e-9
