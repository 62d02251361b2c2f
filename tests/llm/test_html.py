from vetmill.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy now</div>
<article><h1>Title &amp; more</h1><p>One  <b>two</b>
three&nbsp;four<br>five<p>Six &lt;7&gt; {n}</p></article><footer>&copy; host</footer></body></html>"""


def test_article():
    blocks, styles = html.parse(PAGE.format(n=1))
    assert [b[1] for b in blocks] == ["Title & more", "One two three four five", "Six <7> 1"]
    assert not any(b[2] for b in blocks) and styles["/html/body"] == "nav div.ad article footer"


def test_odd_pages():
    text = lambda p: [b[1] for b in html.parse(p)[0]]
    assert text(None) == text("") == text("<p></p>") == []
    assert text("just text") == ["just text"]
    assert text("<article><p>a<p>b") == ["a", "b"]
    assert text("<article><p>a</p><div class='comments'><p>bad</p></div><form><p>no</p></form><p>c</p></article>") == ["a", "c"]
    assert text("<div id=main><main><p>x</main><aside>y</aside>") == ["x"]
    assert text("<div class='with-sidebar'><div class=sidebar><article>no</article></div><article>yes</article><p>no</p></div>") == ["yes"]
    assert text("<div class='site-header'>no</div><p>yes</p>") == ["yes"] and text("<article><header><h1>T</h1></header>x</article>") == ["T", "x"]
    assert text("<article>a<div class='comments'><article>b</article></div></article>") == ["a"]
    assert text("<div>a<script>if (a<b) {}</script>b</div>") == ["ab"]
    assert len(text("<div>" * 3000 + "deep" + "</div>" * 3000)) == 1
    assert text("a < b and c > d <b") == ["a < b and c > d <b"]


def test_style_tree_removes_what_repeats(spark):
    pages = []
    for i in range(40):  # no article here: the tree must tell the box that all pages share
        body = f"<div class='top'><span>Welcome to the site</span></div><div class='body'><p>text {i} alpha</p><p>more {i * 7} beta</p></div>"
        pages.append((i, "http://h.example/x", f"<html><body>{body}</body></html>", "x"))
    pages += [(100, None, None, "x"), (101, "http://small.example/", "<div class='top'><span>Welcome to the site</span></div><div>z</div>", "x"), (100, None, None, "x"), (None, "bad url", "<article>ok</article>", None)]
    got = html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string, host string")).collect()
    assert len(got) == len(pages)
    by = {r.page_id: r for r in got}
    assert by[3].text == "text 3 alpha\nmore 21 beta" and by[3].n_chars == len(by[3].text)
    assert by[100].text == "" and by[100].n_chars == 0 and by[None].text == "ok"
    assert by[101].text == "Welcome to the site\nz"
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_tree_judges_blocks_in_and_outside_articles(spark):
    pages = []
    for i in range(40):
        article = f"<article><h1>title {i}</h1><p>text {i}</p><p>Share this story</p><p>more {i}</p></article>"
        own = f"<div class='lead'><p>lead {i}</p></div>"  # varies from page to page, though outside
        pages.append((i, "http://h.example/x", f"<body><nav><p>Home</p></nav><div class='box'>All rights</div>{own}{article}<div class='ads ad'>buy {i}</div></body>"))
    pages.append((50, "http://small.example/", "<div>out</div><article><p>in</p><p>Share this story</p></article>"))
    pages += [(60 + i, "http://same.example/", "<article><p>all the same</p></article>") for i in range(20)]
    by = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert by[3] == "lead 3\ntitle 3\ntext 3\nmore 3"
    assert by[50] == "in\nShare this story" and by[60] == "all the same"


def test_dropped_branches_enter_the_tree():
    blocks, _ = html.walk("<nav><p>Home</p></nav><p>out <button>no</button>side</p><article>in<span class=ad>no</span></article>")
    assert [(b[1], b[2]) for b in blocks] == [("Home", html.NEVER), ("out side", html.OUTSIDE), ("in", html.ARTICLE)]


def test_broken_pages_take_linear_time():
    import time

    for page in ("<b>" * 100_000 + "</i>" * 100_000, "<a " * 330_000, "<a \"" * 250_000, "<p>" * 100_000 + "<b>" * 100_000 + "</q>" * 100_000, "<!--" * 100_000, "<a '" * 100_000 + ">" + "<b x=\"" * 100_000):
        began = time.perf_counter()
        html.walk(page)
        assert time.perf_counter() - began < 4, page[:10]


def test_importance_like_brute_force(spark):
    """Entropy of presentations and contents of a small site, from the definitions."""
    import math
    from collections import Counter, defaultdict

    pages = []
    for i in range(12):
        extra = "<p>only here</p>" if i % 3 == 0 else ""
        pages.append(f"<div class=a><p>same</p><p>text {i % 4}</p></div><div class=b>{extra}<ul><li>item {i}</li></ul></div>")
    texts, styles = defaultdict(list), defaultdict(list)
    for page in pages:
        blocks, seen = html.walk(page)
        for path, text in {(b[0], b[1]) for b in blocks}:
            texts[path].append(text)
        for path, style in seen.items():
            styles[path].append(style)
    leaf = {p: len({i for i, page in enumerate(pages) if any(b[0] == p for b in html.walk(page)[0])}) for p in texts}

    def content(path):
        n = Counter(texts[path])
        return 1 - sum(math.log(k) for k in n.values()) / len(n) / math.log(leaf[path])

    def style(path):
        n, m = Counter(styles[path]), len(styles[path])
        return -sum(k / m * math.log(k / m) for k in n.values()) / math.log(m)

    want = {}
    for node in {p[: i] for p in texts for i in [k for k, c in enumerate(p) if c == "/"] + [len(p)]}:
        below = [p for p in texts if p == node or p.startswith(node + "/")]
        mean = sum(content(p) * leaf[p] for p in below) / sum(leaf[p] for p in below)
        want[node] = html.OWN_SHARE * style(node) + (1 - html.OWN_SHARE) * mean if node in styles else mean
    rows = html._parsed(spark.createDataFrame([(i, "http://h.example/", p) for i, p in enumerate(pages)], "page_id long, url string, html string"))
    got = {r.path: r.importance for r in html.style_tree(rows.where("row is null").select("host", "path", "kind", "value", "n")).collect()}
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in want), (got, want)
