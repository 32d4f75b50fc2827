"""Main text: the cut next to all labellings, and pages of many shapes."""

import itertools
import random
import time

from tallyvein.llm.html import extract_main, main_blocks, minimum_cut


def cost(scores, edges, labels):
    own = sum(-s if keep and s < 0 else s if not keep and s > 0 else 0 for s, keep in zip(scores, labels))
    return own + sum(c for a, b, c in edges if labels[a] != labels[b])


def test_cut_is_least():
    rng = random.Random(2)
    for _ in range(120):
        n = rng.randrange(1, 10)
        scores = [rng.randrange(-20, 21) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.randrange(12)) for _ in range(2 * n)]
        edges = [e for e in edges if e[0] != e[1]]
        least = min(cost(scores, edges, x) for x in itertools.product([False, True], repeat=n))
        assert cost(scores, edges, minimum_cut(scores, edges)) == least


PAGES = {
    "plain": ("<html><body><nav><a href=/>Home</a><a href=/x>More</a></nav><article><h1>Title &amp; all</h1><p>First  <b>bold</b>\n text.<p>Second &eacute;&#233;&#xe9;.</article><footer>&copy; us</footer>", "Title & all\nFirst bold text.\nSecond ééé."),
    "script": ("<article><p>One<script>var a='</p><p>no';</script> two</p><style>p{}</style><!-- <p>gone</p> --><p>Three</article>", "One two\nThree"),
    "classes": ("<div class='header'>Site</div><div id=cookie-notice>We use cookies to do many things for you</div><div class='content'><p>The story begins here and goes on.</p><div class=ad>Buy this now and be happy ever after</div><p>It ends here after many words.</p></div><div class='comments'><p>Great story, I have read it twice over!</p></div>", "The story begins here and goes on.\nIt ends here after many words."),
    "inside": ("<main><article><header><h1>Head</h1></header><p>Body text of some length here.</p><aside>Related things to read</aside><form><label>Mail</label><input></form><section id=comments><p>No. I do not agree with any of this.</p></section></article></main>", "Head\nBody text of some length here."),
    "links": ("<ul><li><a href=a>One link</a><li><a href=b>Two link</a><li><a href=c>Three link</a></ul><p>A long enough paragraph of plain words stands here, alone and content.</p>", "A long enough paragraph of plain words stands here, alone and content."),
    "broken": ("<article><p class='x>y'>Fine <a href=\"b>c\">text</a> here<p>and 1 < 2 more <b>bold", "Fine text here\nand 1 < 2 more bold"),
    "hidden": ("<article><p>Shown words stand in this place.</p><p style='display: none'>Secret words are not shown</p><p hidden>Nor these words here</p></article>", "Shown words stand in this place."),
    "layout": ("<div class='content with-sidebar'><p>Plain words of a story stand here.</p><p>More of them come after that.</p></div>", "Plain words of a story stand here.\nMore of them come after that."),
    "lacks": ("<article class='post no-sidebar'><p>Plain words of a story stand here.</p></article>", "Plain words of a story stand here."),
    "slug": ("<article id='search-engines-explained'><p>Engines read pages and rank them.</p></article>", "Engines read pages and rank them."),
    "reader": ("<article class='post'><p>Plain words of a story stand here.</p></article><article class='comment'><p>I have read it twice, and so should you.</p></article>", "Plain words of a story stand here."),
    "formula": ("<article><p>Euler found <math><mi>e</mi><mo>=</mo><mn>1</mn></math> long ago.</p><p>See <object data=x>the drawing</object> and <svg><title>Icon</title><text>its label</text></svg> below.</p></article>", "Euler found e=1 long ago.\nSee the drawing and its label below."),
    "rights": ("<h1>A title</h1><p>Plain words of a story stand here, and on they go.</p><p>Copyright law is old, and this story tells of it at length.</p><p>Copyright 2021 The Paper. All rights reserved.</p>", "A title\nPlain words of a story stand here, and on they go.\nCopyright law is old, and this story tells of it at length."),
    "rights inside": ("<article><p>Plain words of a story stand here.</p><p>All rights reserved.</p></article>", "Plain words of a story stand here.\nAll rights reserved."),
    "empty": ("", ""),
    "nothing": ("<nav><a href=x>Only a menu</a></nav>", ""),
    "null": (None, ""),
}


def test_pages(spark):
    rows = [(i, name, page, "clash") for i, (name, (page, _)) in enumerate(PAGES.items())] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_main(pages, "page_id", "html", ("url",)).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"page_id", "url", "text", "n_blocks"}
    for r in got:
        assert r.text == PAGES[r.url][1], r.url
    assert extract_main(pages.limit(0)).count() == 0


def test_cut_of_long_chains():
    """Paragraphs and adverts in turn, and far sources and sinks: the same least cost as over all prefixes' labels."""
    rng = random.Random(7)
    for scores in ([40 if i % 2 else -70 for i in range(12000)], [rng.randrange(-20, 21) for _ in range(3000)], [9] * 1000 + [0] * 1000 + [-9] * 1000):
        edges = [(i, i + 1, 6) for i in range(len(scores) - 1)]
        best = {keep: max(0, -scores[0]) if keep else max(0, scores[0]) for keep in (False, True)}
        for s in scores[1:]:
            best = {keep: min(best[keep], best[not keep] + 6) + (max(0, -s) if keep else max(0, s)) for keep in (False, True)}
        began = time.perf_counter()
        labels = minimum_cut(scores, edges)
        assert time.perf_counter() - began < 5
        assert cost(scores, edges, labels) == min(best.values())


def test_long_and_deep_pages():
    many = "".join(f"<p>Paragraph number {i} has some words.</p>" for i in range(4000))
    assert len(main_blocks(f"<article>{many}</article>")) == 4000
    assert main_blocks("<article>" + "<div>" * 5000 + "Deep words are found here.") == ["Deep words are found here."]
    assert main_blocks("<article>" + "<" * 20000 + "p") != [] and main_blocks("<a href='" * 3000) == []
