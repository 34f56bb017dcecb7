"""Reading of markup, alignment against the textbook recurrence, pairing over any partitioning."""

import random

from stresscast.llm import page_diff
from stresscast.llm.page_diff import CHROME, CONTENT, OPEN


def test_lines_and_zones():
    html = ('<html><head><title>T</title></head><body><header>H</header><div class="cookie-notice">C</div><main><div class="entry-header">'
            '<h1>A &amp; B</h1></div><p>x\n y<b>z</b><p>q<ul><li>1<li>2</ul><div id=comments><p>no</div><aside>s</aside>'
            '<p>last &nbsp; &#233;nd<br>new</main><p>tail<form><input>f</form><script>"</p>"</script><!-- c --></body>')
    assert [tuple(x) for x in page_diff.page_lines(html)] == [
        (CHROME, "H"), (CHROME, "C"), (CONTENT, "A & B"), (CONTENT, "x yz"), (CONTENT, "q"), (CONTENT, "1"), (CONTENT, "2"),
        (CHROME, "no"), (CHROME, "s"), (CONTENT, "last énd"), (CONTENT, "new"), (OPEN, "tail"), (CHROME, "f")]
    assert page_diff.page_lines(None) == page_diff.page_lines("") == []
    assert [x.text for x in page_diff.page_lines("<p>cut &am")] == ["cut &am"]
    assert [x.text for x in page_diff.page_lines("</p></b>a<p>b" + "<i>" * 3000 + "c")] == ["a", "bc"]


def test_names_and_heads_do_not_empty_pages():
    def zones(html):
        return [tuple(x) for x in page_diff.page_lines(html)]
    for wrapper in ('id="page" class="has-sidebar"', 'class="wrap menu-open"', 'class="layout-with-sidebar no-comments"'):
        assert zones(f"<body><div {wrapper}><article><p>a</article><p>b</div>") == [(CONTENT, "a"), (OPEN, "b")]
    assert zones('<article class="post social"><h2 id="social-impact">S</h2><section id="related-work"><p>r</p></section>'
                 '<section id="comments"><h3 id="comments">C</h3></section><div class="related-work">w</div></article>') == [
                     (CONTENT, x) for x in ("S", "r", "C", "w")]
    assert zones('<h2 id="social-impact">S</h2><main class="share"><p>m</main>') == [(OPEN, "S"), (CONTENT, "m")]
    # Chrome stays chrome.
    for part in ('class="share-buttons"', 'class="ad"', 'id="comments"', 'class="x related-posts"'):
        assert zones(f"<article><p>a<div {part}><p>x</div></article>") == [(CONTENT, "a"), (CHROME, "x")], part
    for part in ('class="sidebar"', 'id="cookie-banner"', 'class="left-sidebar"', 'class="site-footer"'):
        assert zones(f"<div {part}><p>x</div><p>a") == [(CHROME, "x"), (OPEN, "a")], part
    for head in ("<html><head><title>T</title><body><p>x", "<head><title>T</title><p>x", "<head><meta a=b><div>x</div>",
                 "<head><title>T</title>x", "<head><title>T</title><noscript><p>n</p></noscript><body>x", "<head><script>1</script><br/>x",
                 "<head><title>T</title></head><body>x"):
        assert zones(head) == [(OPEN, "x")], head


def test_common_lines():
    def longest(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]
    rng = random.Random(19)
    for _ in range(400):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(13))] for _ in range(2))
        kept = [x for x, s in zip(a, page_diff.common_lines(a, b)) if s]
        rest = iter(b)
        assert all(x in rest for x in kept) and len(kept) == longest(a, b)


def site(host, n, rng):
    return [(f"http://{host}/{rng.choice('abc')}/{i}?q=1#f", f"<p>{host} top</p><div>Home</div><p>story {host} {i}</p><p>end of {host}</p>")
            for i in range(n)]


def test_differencing_and_pairs(spark):
    rng = random.Random(20)
    pages = [p for h, n in (("big.example", 60), ("one.example", 1), ("two.example", 2)) for p in site(h, n, rng)]
    pages += [("http://big.example/a/copy", None), (None, "<p>no url</p>"), ("http://x.example/", "<article><p>kept</p></article><p>out</p>"),
              ("http://x.example/2", "<article><p>kept</p><p>own</p></article>"), ("http://one.example/z" + "y" * 9, "<p>" + "long " * 50_000)]
    rows = [(i, u, h) for i, (u, h) in enumerate(pages)] + [(0, *pages[0]), (0, *pages[0]), (None, "http://two.example/b/9", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as text", "'c' as host", "1 as edge")
    old, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n in ("1", "4", "29"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(sorted(map(repr, page_diff.extract_main_text(df).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == len(rows)
    got = {r.url: r for r in page_diff.extract_main_text(df).collect()}
    for i, (u, h) in enumerate(pages[1:60], 1):
        assert got[u].text == f"story big.example {i}" and got[u].partner_id is not None
    assert got[pages[60][0]].text.startswith("one.example top\nHome\nstory")  # the other page shares no line
    assert got["http://x.example/"].text == "kept" and got["http://x.example/2"].text == "kept\nown"
    assert got["http://x.example/2"].n_shared == 1
    assert got["http://big.example/a/copy"].text == "" and got[None].text == "no url" and got[None].partner_id is None
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert page_diff.extract_main_text(df.where("page_id < 0")).count() == 0


def test_rows_of_one_url_have_the_same_partner(spark):
    rng = random.Random(22)
    pages = site("big.example", 40, rng)
    rows = [(i, u, h) for i, (u, h) in enumerate(pages)]
    rows += [(0, *pages[0])] * 2 + [(100 + k, *pages[7]) for k in range(200)]  # repeated rows, and recrawls
    rows += [(300 + 10 * k + j, *pages[j]) for k in range(3) for j in range(10, 14)]
    rows += [(400 + 2 * k + j, f"http://q.example/index.php?id={j}", f"<p>top</p><p>story {j}</p><p>end</p>") for k in range(4) for j in range(2)]
    rows += [(500 + k, "http://lone.example/", f"<p>lone {k}</p>") for k in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    old, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n in ("1", "3", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(sorted(tuple(r) for r in page_diff.extract_main_text(df).select("page_id", "url", "text", "n_shared", "partner_id").fillna(-1).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == len(rows)
    url_of = {i: u for i, u, _ in rows}
    partners = {}
    for i, u, text, _, partner in seen[0]:
        assert partners.setdefault(u, partner) == partner and url_of.get(partner) != u, (i, u, partner)
        if "lone" in u:
            assert partner == -1 and text == f"lone {i - 500}"
        else:
            story = f"story {u[-1]}" if "q.example" in u else f"story big.example {[p for p, _ in pages].index(u)}"
            assert partner >= 0 and text == story, (i, u, text)


def test_one_path_is_many_parts(spark):
    for path in ("index.php", "p" * 300 + "/"):
        df = spark.createDataFrame([(i, f"http://q.example/{path}?id={i}", f"<p>top</p><p>story {i}</p>") for i in range(400)],
                                   "page_id long, url string, html string")
        out = page_diff.extract_main_text(df).selectExpr("text", "page_id", "spark_partition_id() as part").collect()
        assert all(r.text == f"story {r.page_id}" for r in out) and len(out) == 400
        assert len({r.part for r in out}) >= 3
