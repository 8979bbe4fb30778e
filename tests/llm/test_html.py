import math
import re
import tracemalloc
from collections import Counter, defaultdict
from html import unescape

from pyspark.sql import functions as F

from gridflow.llm import html as H
from gridflow.sources.tables import read_table


def article(page):
    """The driver's pages hold one <article> of h1, p and b elements."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    inner = re.sub(r"<[^>]*\Z", "", inner)
    parts = re.split(r"</?(?:h1|p)>", inner)
    return "\n".join(t for t in (" ".join(unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p))).split()) for p in parts) if t)


def test_driver_pages(spark):
    pages = read_table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r for r in H.extract(pages).collect()}
    rows = pages.collect()
    assert {r.page_id: (r.url, article(r.html)) for r in rows} == {k: (r.url, r.text) for k, r in got.items()}
    assert all(r.n_chars == len(r.text) for r in got.values())


def one(page, unimportant=()):
    return H.main_text(page, set(unimportant))


def test_markup_cases():
    assert one("<p>a<b>b</b>c<br>d &amp; e&nbsp;f&lt;p&gt;</p>tail") == "abc d & e f<p>\ntail"
    assert one("x < y <3 &am") == "x < y <3 &am"
    assert one("<p>a<p>b<ul><li>c<li>d</ul>e") == "a\nb\nc\nd\ne"
    assert one("a<!-- <p>no</p> -->b<script>if (1<2) '</p>'</script>c<style>x{}") == "ab\nc"
    assert one("<p title='a > b'>in</p><p class=x>un<p") == "in\nun"
    assert one("<table><tr><td>1<td>2<tr><td>3</table>") == "1\n2\n3"
    assert one("") == "" and one("<p>") == "" and one("</p></div>") == ""
    assert one("<div>" * 3000 + "deep") == "deep"


def test_noise_elements():
    page = """<html><head><title>t</title></head><body class="home"><header>top</header><div id="top-nav">menu</div>
    <div class="cookieConsent">we use</div><main><article><header><h1>Title</h1></header><p>one <em>two</em></p><form>sign</form>
    <aside>see also</aside><div class="ad">buy</div><blockquote>quote</blockquote><section id="comments"><p>first!</p></section>
    <p hidden>no</p></article><div>beside</div></main><article class="comment">mine</article><footer>foot</footer></body></html>"""
    assert one(page) == "Title\none two\nquote"
    assert one("<body><header>top</header><div>text</div><div role='navigation'>n</div><button>b</button></body>") == "text"


def test_site_style_tree_against_direct_computation(spark):
    words = lambda i: f"article {i} tells its own story number {i}"
    rows = []
    for i in range(24):
        links = "".join(f"<div class='l'><a href='/{k}'>link {k}</a></div>" for k in range(3))
        rows.append((i, f"http://Site.example:80/{i}", f"<body><div class='x'>Welcome to the site</div>{links}"
                     f"<div class='t'><p>{words(i)}</p><p>more <b>of</b> {i}{' <i>x</i>' * (i % 3)}</p></div><div class='y'>imprint</div></body>"))
    rows += [(100 + i, "https://small.example/", "<body><div class='x'>Welcome</div><p>text</p></body>") for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.host, r.path): (r.pages, r.importance) for r in H.importance(pages).collect()}
    per = defaultdict(list)
    # equal pages of a host have one vote
    for host, page in {(re.match(r"\w+://([^/:]*)", url)[1].lower(), page) for _, url, page in rows}:
        of = defaultdict(list)
        for b in H.blocks(page):
            of[b.path].append(b)
        for path, bs in of.items():
            per[host, path].append(bs)
    for key, inst in per.items():
        m = len(inst)
        want = 1.0
        if m >= H.MIN_PAGES:
            styles = Counter(b.style for bs in inst for b in bs)
            n = sum(styles.values())
            pres = -sum(v / n * math.log(v / n, len(styles)) for v in styles.values()) if len(styles) > 1 else 0
            texts = {b.text for bs in inst for b in bs}
            ent = []
            for t in texts:
                c = [k for k in (sum(b.text == t for b in bs) for bs in inst) if k]
                ent.append(-sum(k / sum(c) * math.log(k / sum(c), m) for k in c))
            w = H.GAMMA ** len(styles)
            content = 1 - sum(ent) / len(ent)
            want = max(content, (1 - w) * pres + w * content)
        assert got[key][0] == m and abs(got[key][1] - want) < 1e-5
    text = {r.page_id: r.text for r in H.extract(pages).collect()}
    assert text[4] == f"{words(4)}\nmore of 4 x" and text[100] == "Welcome\ntext"


def site(n, inside, host="http://h.example"):
    return [(i, f"{host}/{i}", f"<body><div class='x'>Welcome to the site</div>{inside(i)}<div class='y'>imprint</div></body>") for i in range(n)]


def texts(spark, rows):
    return {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_unmarked_pages_at_any_host_size(spark):
    story = lambda i: f"<div class='t'><p>story {i} is its own</p><p>and <b>goes</b> on {i}</p></div>"
    for n in (10, 10_000):
        got = texts(spark, site(n, story))
        assert len(got) == n and all(t == f"story {i} is its own\nand goes on {i}" for i, t in got.items())


def test_equal_pages_have_one_vote(spark):
    same = [(i, "http://h.example/", "<body><div>one</div><p>two</p></body>") for i in range(20)]
    assert set(texts(spark, same).values()) == {"one\ntwo"}
    story = lambda i: f"<p>story {i}</p>"
    got = texts(spark, site(12, story) + [(100 + i, "http://h.example/", site(1, story)[0][2]) for i in range(500)])
    assert all(t == f"story {i if i < 100 else 0}" for i, t in got.items())


def test_the_tree_decides_inside_a_marked_article(spark):
    inside = lambda i: f"<article><div class='k'>Stay tuned</div><p>a story of its own, number {i}</p></article>"
    rows = site(12, inside)
    assert all(t == f"a story of its own, number {i}" for i, t in texts(spark, rows).items())
    assert texts(spark, rows[:3])[1] == "Stay tuned\na story of its own, number 1"  # a small host says nothing
    # an article that repeats on many pages is no template
    again = [(i, u, h.replace("imprint", f"visit {i}")) for i, u, h in site(12, lambda i: "<article><h1>Title</h1><p>the same words</p></article>")]
    assert set(texts(spark, again).values()) == {"Title\nthe same words"}


def test_class_words_inside_articles():
    assert one("<article class='widget-post'><section class='related-work'>a</section><p class='ad-hoc'>b</p><div class='related-posts'>c</div>"
               "<div class='shareButtons'>d</div><div class='ad'>e</div></article>") == "a\nb"
    assert one("<main class='page-content menu'>in</main><div class='related-work'>out</div>") == "in"


def test_deep_pages():
    tracemalloc.start()
    assert one("<div>" * 100_000 + "deep" + "</div>" * 50_000 + "<p>less") == "deep\nless"
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "no url", ""), (None, "http://a/b", "<p>x</p>"), (3, "http://a", "<p>y</p>"), (3, "http://a", "<p>y</p>"),
            (4, "http://b", "<p>" + "long " * 200_000)]
    pages = spark.createDataFrame([(i, u, h, 1, 2) for i, u, h in rows], "page_id long, url string, html string, host int, path int")
    out = H.extract(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id, r.text[:10], r.n_chars) for r in out.collect()), key=str)
    assert got == sorted([(1, "", 0), (2, "", 0), (None, "x", 1), (3, "y", 1), (3, "y", 1), (4, "long long ", 999_999)], key=str)
    assert H.extract(pages.limit(0)).count() == 0
    wide = H.extracted(pages)
    assert wide.columns == ["page_id", "url", "html", "host", "path", "__main_text"]
    assert wide.where(F.col("__main_text") == "").count() == 2
