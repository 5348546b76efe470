import random
import time

from loomlog.llm import html
from loomlog.llm.html import Page, main_text

SCHEMA = "page_id long, url string, html string, host int, gone int, u int, h int"


def page(body, article=True):
    inner = f"<article>{body}</article>" if article else body
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{inner}</body></html>"


def test_blocks_and_references():
    text = main_text(Page(page("<h1>A &amp; B</h1><p><b>x</b>y&nbsp;&lt;z&gt;<br>n\n  m<p>next &copy &#233;&#x41;<ul><li>one<li>two</ul>")))
    assert text == "A & B xy <z> n m next © éA one two"


def test_boilerplate_goes():
    body = "<nav>menu</nav><header>top</header><div class='sidebar'>side</div><div id='cookie-notice'>c</div><form>f</form><script>if(a<b)'</p>'</script><!-- x --><aside>a</aside>"
    after = "<section class='comments'>c</section><div role=navigation>r</div><div hidden>h</div><footer>foot</footer>"
    assert main_text(Page(page(f"{body}<p>keep</p>{after}", article=False))) == "keep"
    assert main_text(Page(page("<p>one</p><div class='ad'>buy</div><p>two</p><div class=share>s</div>"))) == "one two"
    assert main_text(Page("<body><p>loose</p><article class='post'><p>main</p></article></body>")) == "main"


def test_broken_pages():
    assert main_text(Page("")) == "" and main_text(Page("just < text")) == "just < text"
    assert main_text(Page("<article><p>a<p>b</div></article><p>out")) == "a b"
    assert main_text(Page("<article><p>a<script>never ends")) == "a"
    assert main_text(Page("<article>" + "<div>" * 3000 + "deep")) == "deep"


def test_templates_are_removed(spark):
    rows = []
    for i in range(12):
        rows.append((i, f"http://a.example/{i}", page(f"<p>Story number {i} {'word ' * i}</p><div>Read our house rules</div><p>shared</p>" if i else "<p>lonely story</p>"), 0, 0, 0, 0))
    rows += [(20, None, page("<div>Read our house rules</div>"), 0, 0, 0, 0), (21, "not a url", None, 0, 0, 0, 0), (22, "http://b.example/", page("<p>x</p><div>Read our house rules</div>"), 0, 0, 0, 0)]
    rows += [(40 + i, f"http://c.example/{i}", page("<p>the same article on many pages</p>"), 0, 0, 0, 0) for i in range(9)]
    rows += [(40, "http://c.example/0", page("<p>the same article on many pages</p>"), 0, 0, 0, 0)]
    for limit in (1 << 20, 0):  # broadcast, and the salted join
        got = html.extract_text(spark.createDataFrame(rows, SCHEMA), broadcast_rows=limit).collect()
        text = {r.page_id: r.text for r in got}
        assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
        assert all("house rules" not in text[i] for i in range(12)) and "house rules" in text[20] and "house rules" in text[22]
        assert text[21] == "" and text[0] == "lonely story" and text[45] == "the same article on many pages"
    assert html.extract_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_names_inside_articles():
    body = "<div class='related-work'>w</div><div class='related-posts'>p</div><div id=comments>c</div><div class='noticeable header-image'>n</div><p>k</p>"
    assert main_text(Page(page(body))) == "w n k"
    assert main_text(Page("<nav><article>teaser</article></nav><p>body</p>")) == "body"  # an article in a menu is none


def test_notice_longer_than_the_articles(spark):
    notice = "<div>" + "We keep what you read to ourselves and our friends. " * 30 + "</div><div>also here</div>"
    rows = [(i, f"http://n.example/{i}", page(f"<p>Short {i}.</p>", article=False).replace("</body>", notice + "</body>"), 0, 0, 0, 0) for i in range(40)]
    got = {r.page_id: r.text for r in html.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"Short {i}." for i in range(40)}


def test_counts_equal_brute_force(spark):
    rng = random.Random(4)
    pool = [f"<div>block {k}</div>" for k in range(12)]
    rows = []
    for i in range(150):
        host = f"h{i % 3}.example"
        inside = "".join(rng.sample(pool, rng.randint(0, 5)))
        rows.append((i, f"http://{host}/{i}", page(f"<p>own {rng.randrange(60)}</p>{inside}", article=i % 2 == 0), 0, 0, 0, 0))
    got = {r.page_id: r.text for r in html.extract_text(spark.createDataFrame(rows, SCHEMA), share=0.2, article_share=0.3, many=30).collect()}
    for host in range(3):
        own = {r[2] for r in rows if r[0] % 3 == host}  # different pages
        on = lambda b: sum(b in x for x in own)
        only_inside = lambda b: all("<article>" in x for x in own if b in x)
        gone = {b for b in {*pool, *[f"<p>own {k}</p>" for k in range(60)]} if on(b) >= 5 and (on(b) >= 0.2 * len(own) or on(b) >= 30)}
        for i, _, h, *_ in rows:
            if i % 3 == host:
                body = h
                for b in gone:
                    if "<article>" not in h or on(b) >= 0.3 * len(own):
                        body = body.replace(b, "<br>")
                assert got[i] == main_text(Page(body)), i
    assert any("block" in t for t in got.values()) and any("block" not in t for t in got.values())


def test_broken_markup_takes_linear_time():
    for unit in ("a<b ", '<div "a ', "<a x='>\" ", "<div><main></div>", "<li><b>", "<p><button><div>", "</x>", "<div></span>", "<!-", "<script", '<a b=">" ', "&amp", "<td><i>"):
        for tail in ("", ">", "'", '">'):
            source = unit * (300_000 // len(unit)) + tail
            began = time.time()
            main_text(Page(source), {1: True})
            assert time.time() - began < 4, (unit, tail)
