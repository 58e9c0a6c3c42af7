import html as htmllib
import random
import re

from eventlake.llm import extract

SCHEMA = "page_id long, url string, html string, text int, host string"


def run(spark, rows):
    got = extract.extract(spark.createDataFrame([(*r, 1, "h") for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows) and all(r.rest.text == 1 and r.rest.host == "h" for r in got)
    return {(r.id, r.url): r.text for r in got}


def test_given_pages(spark):
    """Held against a plain reading of their articles."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.id: r.text for r in extract.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [" ".join(htmllib.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(p for p in parts if p)


def page(rng, i, host):
    words = lambda n: " ".join("w%d" % rng.randrange(999) for _ in range(n))
    body = [words(rng.randrange(20, 60)) for _ in range(rng.randrange(2, 7))]
    html = (
        f"<html><body><div><div>Welcome to {host}</div><span>Home</span><span>About us</span></div><div><div><b>{words(4)}</b>"
        + "".join(f"<p>{b}" for b in body)
        + "<div>Like what you read? Tell a friend.</div></div></div><div>All pages of this site &copy; 2020</div><div class='comments'><p>First!</p></div></body>"
    )
    return html, body


def test_template_of_a_host_without_an_article_element(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(30):
        host = f"site{i % 3}.org"
        html, body = page(rng, i, host)
        rows.append((i, f"http://{host}/{i}", html))
        want[i] = body
    got = run(spark, rows)
    for (i, _), text in got.items():
        assert [x for x in text.split("\n") if len(x) > 60] == [b for b in want[i] if len(b) > 60]
        for junk in ("Welcome", "About us", "Tell a friend", "All pages", "First!"):
            assert junk not in text


def tree(source):
    return extract.numbered(extract.parse(source))


def test_matching_is_simple_tree_matching():
    a = tree("<div><p>a</p><ul><li>1</li><li>2</li></ul><p>b</p></div>")
    b = tree("<div><p>a</p><table></table><ul><li>1</li></ul><p>c</p></div>")
    weight, pairs = extract.match(a, b)
    assert len(pairs) == 6 and weight == 8  # root, div, p, ul, li, p; two of them with equal text
    assert extract.match(a, tree("<span>x</span>"))[0] == 1


def brute_weight(a, b):
    """The recurrence, with nothing cut off beforehand."""
    if (a.tag, a.name) != (b.tag, b.name):
        return 0
    x, y = a.elements, b.elements
    m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, p in enumerate(x):
        for j, q in enumerate(y):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + brute_weight(p, q))
    return 1 + (a.mark == b.mark != 0) + m[-1][-1]


def test_matching_equals_the_recurrence():
    rng = random.Random(8)

    def some(depth):
        tag = rng.choice(["p", "div", "span"])
        kids = "".join(some(depth - 1) for _ in range(rng.randrange(4))) if depth and tag != "p" else ""
        return f"<{tag}>{rng.choice(['', 'x', 'y'])}{kids}</{tag}>"

    for _ in range(200):
        a, b = (tree("".join(some(2) for _ in range(3))) for _ in range(2))
        weight, pairs = extract.match(a, b)
        assert weight == brute_weight(a, b)
        assert weight == len(pairs) + sum(u.mark == v.mark != 0 for u, v in pairs)
        by = sorted((u.number, v.number) for u, v in pairs)
        assert len({u for u, _ in by}) == len(by) and all(p[1] < q[1] for p, q in zip(by, by[1:], strict=False))


def test_long_lists_are_cut_at_what_occurs_once():
    items = [f"<li>{i}</li>" for i in range(900)]
    a, b = tree("<ul>" + "".join(items) + "</ul>"), tree("<ul>" + "".join(x for i, x in enumerate(items) if i % 7) + "<li>new</li></ul>")
    equal = sum(u.mark == v.mark != 0 for u, v in extract.match(a, b)[1])
    assert equal == sum(1 for i in range(900) if i % 7)


def test_matching_does_not_depend_on_the_lists_length(monkeypatch):
    """Lists beyond PAIRS get the best matching, the one that shorter ones get."""
    rng = random.Random(5)

    def some(n):
        inner = lambda: "".join(f"<b>{rng.choice('xyz')}</b>" for _ in range(rng.randrange(3)))
        return tree("".join(f"<{t}>{rng.choice(['', 'a', 'b', rng.randrange(99)])}{inner()}</{t}>" for t in rng.choices(["i", "u", "s"], k=n)))

    # the one equal text is no place to cut at: all others lie across it
    far = tree("<i>k</i>" + "<u>a</u>" * 80), tree("<u>a</u>" * 79 + "<s></s><i>k</i>")
    cases = [far, *((some(n), some(m)) for n, m in ((0, 3), (1, 1), (5, 9), (70, 66), (90, 61), (130, 40)))]
    number = lambda found: (found[0], [(u.number, v.number) for u, v in found[1]])
    given = [number(extract.match(a, b)) for a, b in cases]
    for pairs, weighed in ((0, 0), (0, 10**9), (10**9, 0)):
        monkeypatch.setattr(extract, "PAIRS", pairs)
        monkeypatch.setattr(extract, "WEIGHED", weighed, raising=False)
        assert [number(extract.match(a, b)) for a, b in cases] == given
    assert [w for w, _ in given] == [brute_weight(a, b) for a, b in cases]


def words(rng, n):
    return " ".join("w%d" % rng.randrange(9999) for _ in range(n))


def test_all_layouts_of_a_host_and_constants_after_varying_runs(spark):
    """A menu without a telling name in each of two layouts, a last paragraph
    after a varying number of others, inside an article too; and copies."""
    rng = random.Random(9)
    rows, want = [], {}
    for i in range(40):
        body = [words(rng, 8) for _ in range(rng.randrange(1, 6))]
        paragraphs = "".join(f"<p>{b}</p>" for b in body)
        if i % 4 == 0:
            page = f"<body><div class=x><span>Home of A</span></div><div>{paragraphs}<p>Written by the team.</p></div></body>"
        else:
            page = f"<body><section><table><tr><td>Home of B</td></tr></table></section><article>{paragraphs}<p>Written by the team.</p></article></body>"
        rows.append((i, "http://one.org/%d" % i, page))
        want[i] = "\n".join(body)
    # many copies of one page: its text is no template for that
    rows += [(100 + k, f"http://one.org/copy{k}", rows[1][2]) for k in range(200)]
    got = {i: text for (i, _), text in run(spark, rows).items()}
    assert all(got[i] == want[i] for i in range(40)) and all(got[100 + k] == want[1] for k in range(200))


def test_names_do_not_delete_a_whole_page(spark):
    text = lambda s: extract.main_text(s, None)
    assert text("<body><form id=aspnetForm><script>s</script><div><p>All of it</p></div></form></body>") == "All of it"
    assert text('<div class="search-results notice"><p>Real text</p></div>') == "Real text"
    rng = random.Random(10)
    body = [words(rng, 12) for _ in range(6)]
    rows = [(i, f"http://f.org/{i}", f"<form><div class=top>Our shop</div><div><p>{b}</p></div><div>All rights</div></form>") for i, b in enumerate(body)]
    assert [t for _, t in sorted((i, t) for (i, _), t in run(spark, rows).items())] == body


def test_constants_alone(spark):
    """Without names, what all pages of a host share still goes."""
    rng = random.Random(11)
    body = [words(rng, 15) for _ in range(8)]
    rows = [(i, f"http://n.org/{i}", f"<nav><ul><li>Home<li>News</ul></nav><article><h1>{b}</h1></article><footer>Imprint</footer>") for i, b in enumerate(body)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.id: r.text for r in extract.extract(df, names=False).collect()} == dict(enumerate(body))


def test_parser_and_roles():
    text = lambda s: extract.main_text(s, None)
    assert text("a &amp; b&nbsp;c &#233;&lt;p&gt;") == "a & b c é<p>"
    assert text("<p>one<p>two<br>three <b>four</b>five</p>six") == "one\ntwo three fourfive\nsix"
    assert text("<script>if (a < b) '<p>x</p>'</script><style>p{}</style><p>y<!-- <p>z</p> --></p><noscript>n</noscript>") == "y"
    assert text("<header>H</header><main><header><h1>T</h1></header><p>x</p><aside>A</aside><form>F</form></main><footer>B</footer>") == "T\nx"
    assert text("<article><p>long enough text</p></article><article class='comment'><p>much longer text of a reader's comment</p></article>") == "long enough text"
    assert text("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>") == "a\nb\nc\nd\ne"
    assert text("<p title='a > b'>x</p><img alt='>'>y</div></span>z") == "x\nyz"
    assert text("<div hidden>a</div><div role=navigation>b</div><div id='cookie-notice'>c</div><p>d</p>") == "d"
    assert text("<div>" * 5000 + "deep" + "</div>" * 5000 + "end") == "deep\nend"


def test_no_part_of_the_text_is_dropped_for_its_size():
    text = lambda s: extract.main_text(s, None)
    long, short = "long " * 90, "short " * 10
    assert text(f"<body><div><h1>Title</h1><div class=body><p>{long}</p></div></div></body>") == f"Title\n{long.strip()}"
    assert text(f"<div><div><p>{long}</p></div><div><p>{short}</p></div></div>") == f"{long.strip()}\n{short.strip()}"
    assert text(f"<article><p>{short}</p></article><article><p>{long}</p></article>") == f"{short.strip()}\n{long.strip()}"
    assert text("<main><h1>Title</h1><article><p>x</p></article></main>") == "Title\nx"
    assert text("<article></article><div><p>x</p></div>") == "x"


def test_edge_rows(spark):
    many = "<p>" + "word " * 100_000 + "</p>"
    rows = [(1, "http://a.org/", None), (2, "http://a.org/", ""), (3, None, "<p>x</p>"), (4, "no host", "plain\n text"), (None, "http://a.org/", "<p>y"), (5, "http://a.org/", many), (6, "http://b.org/1", "<p>same</p>"), (7, "http://b.org/2", "<p>same</p>"), (7, "http://b.org/2", "<p>same</p>"), (8, "http://a.org/", "<"), (9, "http://a.org/", "</p><p")]
    got = run(spark, rows)
    assert got[1, "http://a.org/"] == got[2, "http://a.org/"] == ""
    assert got[3, None] == "x" and got[4, "no host"] == "plain text" and got[None, "http://a.org/"] == "y"
    assert got[5, "http://a.org/"] == ("word " * 100_000).strip() and got[7, "http://b.org/2"] == "same"
    assert got[8, "http://a.org/"] == "<"
    assert run(spark, []) == {}
