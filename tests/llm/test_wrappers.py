import time

from condoflow.llm import wrappers
from condoflow.llm.wrappers import align, fold, main_text, op3_html_extraction

PAGES = [
    (1, "http://a.example/1", "<html><body><nav><ul><li><a href=x>Home</a></li><li>News</li></ul></nav><article><h1>T &amp; U</h1><p>One <b>two</b>\n three<p>Four"
     "<br>five</article><footer>f</footer></body></html>"),
    (2, "http://a.example/2", "<body><div class='ad box'>Buy</div><article><h1>Two</h1><ul><li>x<li>y</ul><p>1 &lt; 2 <span class=\"ad\">ad</span> end</p>"
     "<div id=comments><p>first!</p></div><script>var a='<p>no</p>'</script></article></body>"),
    (3, "http://b.example/", "<p>plain</p> tail <div>more<aside>side</aside></div>"),
    (4, None, None), (5, "", ""), (6, "no url", "just text"), (7, "http://a.example/3", "<body><article></article>"),
    (8, "http://c.example/", "<header>h</header><main><p>m</p><form><p>f</p></form></main><p>out</p>"), (8, "http://c.example/", "<p>a</p>" * 3000),
]
TEXTS = {
    1: "T & U\nOne two three\nFour\nfive", 2: "Two\nx\ny\n1 < 2 end", 3: "plain\ntail\nmore", 4: "", 5: "", 6: "just text", 7: "",
}


def test_text_of_awkward_pages(spark):
    frame = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id long, url string, html string, host string, text string")
    out = op3_html_extraction(frame.repartition(3)).collect()
    assert len(out) == len(PAGES)
    assert {r.page_id: r.text for r in out if r.page_id < 8} == TEXTS
    assert sorted(r.text for r in out if r.page_id == 8) == sorted(["m", "\n".join("a" * 3000)])
    assert all(r.n_chars == len(r.text) for r in out)
    assert op3_html_extraction(frame.limit(0)).collect() == []


def test_repeats_fold_and_mismatches_become_optional():
    assert fold(["a", "b", "b", "b", "c", "d", "c", "d"]) == ["a", ["+", ["b"]], ["+", ["c", "d"]]]
    assert align(["a", "b", "c"], ["a", "c"]) == ["a", ["?", ["b"]], "c"]
    assert align(["a", ["+", ["b"]], "c"], ["a", "b", "c"]) == ["a", ["+", ["b"]], "c"]
    both = align(["a", ["?", ["b"]], "c"], ["a", "b", "c"])
    assert both == ["a", ["?", ["b"]], "c"]


def test_given_pages_give_their_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in op3_html_extraction(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inside = r.html.split("<article>")[1].split("</article>")[0]
        assert r.text and "©" not in r.text and "<" not in r.text.replace("<<", "")
        assert len(r.text) <= len(inside) and wrappers.html.unescape(inside.split("<h1>")[1].split("</h1>")[0]).split()[0] == r.text.split()[0]


def test_elements_that_only_look_aside_stay_and_markup_never_leaks():
    def text(page):
        return main_text(page, "<article" in page, frozenset())

    assert text('<article class="widget-review"><p>Whole article</p></article>') == "Whole article"
    assert text('<article><p>one</p></article><article class="related"><p>two</p></article>') == "one\ntwo"
    assert text('<p>a</p><div><span class="share-bar"><span>Tweet</span> LIKE US</span>b</div>') == "a\nb"
    assert text('<p title="x>Broken</p><p>fine') == "Broken\nfine"
    assert text("<figure><figcaption>caption</figcaption></figure><fieldset>f</fieldset>") == "caption\nf"
    assert text("1 < 2 <b>x</b> <3 a<") == "1 < 2 x <3 a<"
    assert text("a<!-- x > <p>no") == "a" and text("a<![CDATA[ x ]]>b<?php x ?>c") == "abc"


def test_text_that_most_pages_of_a_host_share_is_wrapper(spark):
    menu = "<div class=x1><ul><li>Home<li>About</ul></div>"
    pages = [(k, "http://m.example/%d" % k, f"<body>{menu}<div><p>Real text number {k}, which only this page has.</p></div><div>All rights {k % 2}</div>") for k in range(6)]
    copies = [(10 + k, "http://same.example/%d" % k, f"<body><p>A long text that all pages have.</p><p>{k}</p>") for k in range(6)]
    equal = [(20, "http://equal.example/", "<p>Home</p><p>This is a row given six times.</p>")] * 6
    few = [(30 + k, "http://few.example/%d" % k, f"<body>{menu}<div><p>Text {k}</p></div>") for k in range(3)]
    frame = spark.createDataFrame(pages + copies + equal + few, "page_id long, url string, html string").repartition(4)
    out = {r.page_id: r.text for r in op3_html_extraction(frame).collect()}
    assert all(out[k] == f"Real text number {k}, which only this page has.\nAll rights {k % 2}" for k in range(6))
    assert all(out[10 + k] == f"A long text that all pages have.\n{k}" for k in range(6))
    assert out[20] == "Home\nThis is a row given six times."
    assert all(out[30 + k] == f"Home\nAbout\nText {k}" for k in range(3))


def test_fixed_texts_match_a_plain_count(spark):
    words = "Home About News Shop Help".split()
    pages = [(f"h{k % 3}", "".join(f"<div><p>{w}</p></div>" for j, w in enumerate(words) if (k // 3 + j) % (j + 2)) + f"<p>{k % 7}</p>") for k in range(40)]
    frame = spark.createDataFrame(pages, "host string, html string").repartition(5)
    found = {r.host: set(r.fixed) for r in wrappers.fixed_texts(frame).collect()}
    plain = {}
    for host in {h for h, _ in pages}:
        blocks = [{(p.key, t) for p, t in wrappers.text_blocks(page)[0]} for page in {page for h, page in pages if h == host}]
        for key, text in set().union(*blocks):
            with_slot = [b for b in blocks if any(k == key for k, _ in b)]
            if len(with_slot) >= 4 and sum((key, text) in b for b in with_slot) >= 0.75 * len(with_slot):
                plain.setdefault(host, set()).add(wrappers.digest(f"{key}#{text}"))
    assert found == plain and plain


def test_work_grows_with_the_length_of_a_page():
    for unit in ("<a ", '<a "', "<a '>", "<!x", "<div>x", "</b>", "<span class=ad><span>", "<", '<a ">', "<![CDATA["):
        start = time.perf_counter()
        main_text(unit * (2_000_000 // len(unit)), False, frozenset())
        assert time.perf_counter() - start < 20, unit


def test_the_wrapper_decides_which_slots_are_main_text(spark):
    """Articles inside an article are replies where the host's wrapper repeats them, also on a page with one of them."""
    def page(replies, part=""):
        return f"<body><article><h1>T</h1><p>Own text.</p>{part}<section>{''.join(f'<article><p>{r}</p></article>' for r in replies)}</section></article>"

    rows = [(1, "http://a.example/1", page(["one reply"])), (2, "http://a.example/2", page(["first", "second"], "<div><article><p>Box</p></article></div>")),
            (3, "http://b.example/1", page(["a part"])), (4, "http://b.example/2", page([])),
            (5, "http://c.example/1", "<main><article><p>one</p></article><article><p>two</p></article></main>"),
            (6, "http://d.example/1", "<article><h1>Parts</h1><article><p>one</p></article><article><p>two</p></article></article>"),
            (7, "http://e.example/1", "<body><article></article><p>x</p>"), (8, "http://e.example/2", "<body><article><p>y</p></article><p>x</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    out = {r.page_id: r.text for r in op3_html_extraction(frame).collect()}
    assert out == {1: "T\nOwn text.", 2: "T\nOwn text.\nBox", 3: "T\nOwn text.\na part", 4: "T\nOwn text.", 5: "one\ntwo", 6: "Parts\none\ntwo", 7: "", 8: "y"}


def test_every_block_has_its_slot_in_the_wrapper_and_without_wrapper_there_is_no_text(spark):
    pages = [(r.html, wrappers.skeleton(r.html)) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(20).collect()]
    pages += [(p, wrappers.skeleton(p)) for p in ("<body><div>a<p>b</div>c<br>d", "<section>e<b>f</b></section>", "<p> &nbsp; <i>g</i><table><tr><td>h")]
    wrapper = []
    for _, other in pages:
        wrapper = align(wrapper, other)
    slots = wrappers.main_slots(wrapper)
    for page, _ in pages:
        assert {place.slot for place, _ in wrappers.text_blocks(page)[0]} <= slots
        assert main_text(page, "<article" in page, frozenset(), slots) == main_text(page, "<article" in page, frozenset())
        assert main_text(page, "<article" in page, frozenset(), wrappers.main_slots([])) == ""
