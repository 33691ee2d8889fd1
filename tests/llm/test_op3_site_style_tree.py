from tallyspark.llm import op3_site_style_tree as op
from tallyspark.llm.tables import table

SCHEMA = "page_id long, url string, html string"


def texts(spark, rows, **kw):
    return {r.page_id: r.text for r in op.extract(spark.createDataFrame(rows, SCHEMA), **kw).collect()}


def test_blocks_references_and_furniture():
    page = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>'</script></head><body>"
            "<header>Site</header><nav><ul><li>x</li></ul></nav><!-- c --><div class='ad box'>Buy</div>"
            "<article><header><h1>A &amp; B</h1></header><p><b>one\n two<br>three<p>four&nbsp;five"
            "<form>q</form><div id='comments'>bad</div><ul><li>i<li>ii</ul></article><aside>s</aside><footer>f</footer>")
    assert op.main_text(page) == "A & B\none two three\nfour five\ni\nii"


def test_role_words_around_and_inside_the_text():
    article = "<article><h1 class='entry-header'>T</h1><p class=social>a b</p><div class=share>s</div></article>"
    for around in ("div class='container has-sidebar'", "div id=content class='comments-open'", "section class='search-result'"):
        tag = around.split()[0]
        page = f"<{around}><div class=ad>Buy</div>{article}</{tag}><div class=sidebar>menu</div>"
        assert op.main_text(page) == "T\na b", around
        assert op.main_text(page.replace("article", "main")) == "T\na b", around
        # Without an article, the branch with most of the text.
        page = f"<div class=menu>x y</div><{around}><p>one two three four five</p><div class=ad>Buy</div></{tag}>"
        assert op.main_text(page) == "one two three four five", around
    comments = "<div id=comments>" + "<article id=comment-1><p>long reply to it and more</p></article>" * 9 + "</div>"
    assert op.main_text(article + comments) == "T\na b"


def test_without_an_article_the_rest_is_taken():
    assert op.main_text("<div>a <i>b</i></div>c<div role=navigation>n</div><div hidden>h</div>") == "a b\nc"


def test_broken_markup():
    for html, want in [("", ""), ("<", "<"), ("<p", ""), ("a < b & c", "a < b & c"), ("</p></div>x", "x"),
                       ("<script>x", ""), ("<!-- open", ""), ("<p class='x>text", ""), ("<b><p>a</b>b", "a\nb")]:
        assert op.main_text(html) == want, html
    assert op.main_text("<div>" * 20_000 + "deep") == "deep"


def test_template_branches_of_a_host_are_removed(spark):
    rows = [(i, "http://h.example/x", f"<div class=top>Welcome to the site</div><div class=body>text {i * i}</div>")
            for i in range(12)]
    rows += [(100 + i, "http://few.example/x", "<div class=top>Welcome</div><div class=body>b</div>") for i in range(3)]
    got = texts(spark, rows)
    assert all(got[i] == f"text {i * i}" for i in range(12))
    assert all(got[100 + i] == "Welcome\nb" for i in range(3))  # too few pages for statistics


def test_copied_pages_are_not_a_template(spark):
    same = "<article><h1>T</h1><p>copied text</p></article>"
    rows = [(i, "http://h.example/x", same) for i in range(50)]
    rows += [(100 + i, "http://h.example/y", f"<article><h1>T{i}</h1><p>own {i}</p></article>") for i in range(9)]
    assert all(texts(spark, rows)[i] == "T\ncopied text" for i in range(50))


def test_awkward_rows(spark):
    rows = [(None, None, "<p>a</p>"), (1, None, None), (1, "http://x/", ""), (2, "not a url", "<p>b"), (2, "not a url", "<p>b")]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F
    out = op.extract(df.withColumn("text", F.lit("clash")).withColumn("paths", F.lit(1)))
    assert sorted((str(r.page_id), r.text) for r in out.collect()) == [("1", ""), ("1", ""), ("2", "b"), ("2", "b"), ("None", "a")]
    assert op.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_page_gives_its_article(spark, sf_small):
    """The pages of the test data: one article of a heading and paragraphs."""
    import html
    import re
    rows = op.query(spark, sf_small).collect()
    pages = {r.page_id: r.html for r in table(spark, sf_small, "pages").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:h1|p)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_quotes_in_attributes():
    for html, want in [("<p title=o'neil>Hello</p><p>More</p>", "Hello\nMore"), ("<p class=\"a\"\">one</p><p>two</p>", "one\ntwo"),
                       ("<p title='a > b' x=\"<p>\">one</p>", "one"), ("<p a= b = 'c>d' =e>x", "x"), ("<p a=>x", "x"), ("<p ' \">x", "x"),
                       ("<div class=nav\"x>n</div>t", "t"), ("<a href=http://e/?a=b&c='d'>x</a>", "x")]:
        assert op.main_text(html) == want, html


def test_long_flat_markup_takes_linear_time():
    import time
    n = 20_000
    pages = ["<b>" * n, "<b>" * (n // 2) + "</i>" * (n // 2), "<span>" * n + "<p>" * n, "<li>" + "<ul>" + "<b>" * n + "<li></li>" * n,
             "<p a=" * n, "<p '" * n, "<" * n, "<a b='" * n, "<!--" * n]
    for page in pages:
        began = time.time()
        op.main_text(page)
        op._paths(op.parse(page))
        assert time.time() - began < 8, page[:20]


def test_one_article_under_different_adverts(spark):
    rows = [(i, "http://h.example/x", f"<div class=promo{i}x>Advert {i}</div><article><h1>T</h1><p>the same text</p></article>") for i in range(10)]
    rows += [(50 + i, "http://k.example/x", f"<article><h2>Summary</h2><p>own words {i}</p><div class=box>Read on every day</div><p>The end.</p></article>")
             for i in range(10)]
    got = texts(spark, rows)
    assert all(got[i] == "T\nthe same text" for i in range(10))
    # Headings and paragraphs stay, a container that is the same in different articles goes.
    assert all(got[50 + i] == f"Summary\nown words {i}\nThe end." for i in range(10))


def brute_tree(pages, threshold, min_pages):
    """Removable style paths of one host, plainly: different pages by main text, one
    distribution each of child styles and of contents per path."""
    import math
    from collections import Counter, defaultdict
    seen = defaultdict(dict)
    for html in pages:
        key = op.main_text(html) or html
        found = defaultdict(lambda: ([], []))

        def content(node):
            return tuple(content(c) if isinstance(c, op.Node) else " ".join(c.split()) for c in node.children)

        def walk(node, above):
            for c in node.children:
                if isinstance(c, op.Node):
                    path = (*above, c.style)
                    styles = [x.style for x in c.children if isinstance(x, op.Node)]
                    found[path][0].append(tuple(s for i, s in enumerate(styles) if not i or styles[i - 1] != s))
                    found[path][1].append(content(c))
                    walk(c, path)
        walk(op.parse(html), ())
        for path, (below, inside) in found.items():
            seen[path].setdefault(key, set()).add((frozenset(below), tuple(sorted(map(repr, inside)))))
    out = set()
    for path, by_page in seen.items():
        m = len(by_page)
        if m >= min_pages and all(len(v) == 1 for v in by_page.values()):
            one = [next(iter(v)) for v in by_page.values()]
            low = [sum(n * math.log(m / n) for n in Counter(x[i] for x in one).values()) / (m * math.log(m)) for i in (0, 1)]
            if 1 - (1 - low[0]) * (1 - low[1]) <= threshold:
                out.add(path)
    return out


def test_tree_matches_brute_force_on_random_hosts(spark):
    import random

    import xxhash
    rnd = random.Random(3)
    for case in range(3):
        pages = []
        for i in range(14):
            blocks = [f"<div class=c{b}><span>{'fixed' if rnd.random() < 0.9 - 0.3 * b else f'own {i}'}</span>{'<i>x</i>' * rnd.randint(0, b)}</div>"
                      for b in range(4)]
            pages.append(f"<div class=w>{''.join(blocks)}<p>text {i}</p></div>")
        df = spark.createDataFrame([("h", p) for p in pages], "host string, html string")
        got = {p & 0xFFFFFFFFFFFFFFFF for r in op.removable_paths(df, 0.4, 8).collect() for p in r.paths}
        want = set()
        for path in brute_tree(pages, 0.4, 8):
            h = 0
            for style in path:
                h = xxhash.xxh64_intdigest(style, h)
            want.add(h)
        assert got == want and want


def test_pages_that_only_the_tree_decides(spark):
    """Menus and notices without a telling tag, role or word: with the tree they go, without it they stay."""
    pages = [f"<div class=xa>Home About Contact</div><div class=xb><h1>Title {i}</h1><p>Body {i} of the text</p></div><div class=xc>All rights kept</div>"
             for i in range(12)]
    rows = [(i, "http://plain.example/p", p) for i, p in enumerate(pages)]
    got = texts(spark, rows)
    assert all(got[i] == f"Title {i}\nBody {i} of the text" for i in range(12))
    assert sum(got[i] != op.main_text(p) for i, p in enumerate(pages)) == 12
