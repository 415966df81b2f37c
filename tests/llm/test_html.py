import json

from quarry.llm import html

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body class="has-sidebar">
<header><a href="/">Home {i}</a></header><nav><ul><li><a href=/x>menu {i}</a></li></ul></nav>
<div class="cookie-notice">We use cookies {i}</div><!-- ad --><div class="ad">Buy {i}</div>
<div id="wrap"><div class="story"><h2>Title {i} &amp; more</h2><p>First   para {i}<br>goes&nbsp;on.</p>
<p>Second <b>para</b> {i}<p>Third {i}</p><p>Read our newsletter terms</p></div></div>
<form>q<input name=q> go {i}</form><section class="comments"><p>nice {i}</p></section>
<script>var a = "</p>{i}";</script><aside>side {i}</aside><footer>&copy; {i}</footer></body></html>"""


def wrapper(pages):
    total = None
    for p in pages:
        one = html._page_wrapper(p)
        total = one if total is None else html.merge_wrappers(total, one)
    return json.loads(json.dumps(total))


def test_template_and_content():
    pages = [PAGE.format(i=i) for i in range(6)]
    w = wrapper(pages)
    assert html.extract(pages[2], w) == "Title 2 & more\nFirst para 2 goes on.\nSecond para 2\nThird 2"
    # one page alone has no template
    assert html.extract(pages[2], wrapper(pages[:1])).endswith("Third 2\nRead our newsletter terms")


def test_order_of_merging_does_not_matter():
    pages = [PAGE.format(i=i) for i in range(6)]
    a = html.merge_wrappers(wrapper(pages[:2]), wrapper(pages[2:]))
    assert html.extract(pages[0], a) == html.extract(pages[0], wrapper(pages[::-1]))


def test_copies_are_not_template():
    pages = [PAGE.format(i=1)] * 5
    assert "Second para 1" in html.extract(pages[0], wrapper(pages))


def test_article_wins_and_keeps_its_own_header():
    page = ("<body><div class=intro>welcome</div><article class=comment>no</article><article><header><h1>H</h1></header>"
            "<p>x &lt;y&gt;</p><footer>by</footer><ul><li>a<li>b</ul><div class='share-buttons'>s</div></article>")
    assert html.extract(page) == "H\nx <y>\na\nb"


def test_names_do_not_drop_the_article():
    body = "<h2>T</h2><p>The first paragraph.</p><p>The second paragraph.</p>"
    want = "T\nThe first paragraph.\nThe second paragraph."
    for page in (f'<div class="layout no-sidebar"><article>{body}</article></div>',
                 f'<div id="content" class="has-menu">{body}</div>', f'<article class="post has-comments">{body}</article>',
                 f'<div class="related-work">{body}</div><div class="sidebar"><p>x</p></div>',
                 f'<div class="banner"><article>{body}</article></div>', f'<ul class="menu"><li>T<li>The first paragraph.'
                 '<li>The second paragraph.</ul>'):
        assert html.extract(f"<body>{page}</body>") == want, page
    assert html.extract(f'<div>{body}</div><div class="comments"><p>{"long remark " * 50}</p></div>') == want


def test_simple_tree_matching():
    leaf = lambda k: [k, 1, [], []]
    size, pairs = html.match([leaf("a"), leaf("b"), ["c", 1, [], [leaf("d"), leaf("e")]]],
                             [leaf("b"), ["c", 1, [], [leaf("e")]], leaf("a")])
    assert size == 3 and pairs == [(1, 0), (2, 1)]


def test_odd_input():
    assert html.extract(None) == html.extract("") == html.extract("<script>x") == ""
    assert html.extract("plain <b>x</b> & y") == "plain x & y"
    assert html.extract("<div>" * 3000 + "deep") == "deep"
    assert html.extract("<p>a<!-- never closed") == "a"
    assert html.extract("a < b <p class=x>c</p") .startswith("a < b")
    assert html.extract("<p>" + "long " * 200_000).count("long") == 200_000


def test_query_shape(spark):
    rows = [(i, f"https://h.example/{i}", PAGE.format(i=i), "x") for i in range(8)]
    rows += [(20, None, None, "x"), (21, "not a url", "", "x"), (22, "http://h.example/9", PAGE.format(i=9), "x"), rows[0],
             (None, "http://u@H.EXAMPLE:80/", PAGE.format(i=10), "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    got = html.main_text(df.repartition(4)).collect()
    assert sorted(str(r.page_id) for r in got) == sorted(str(r[0]) for r in rows)
    by = {r.page_id: r for r in got}
    assert by[3].text == "Title 3 & more\nFirst para 3 goes on.\nSecond para 3\nThird 3"
    assert by[None].text.startswith("Title 10") and by[20].text == by[21].text == ""
    assert all(r.n_chars == len(r.text) for r in got)
    assert html.main_text(df.limit(0)).count() == 0
