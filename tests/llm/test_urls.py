import random

from eventlake.llm import urls

SCHEMA = "page_id long, url string, html string, host int, label string"


def brute(url):
    """Host, path and longest fitting rule, by the definition."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        at = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:at], rest[at:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    best = None
    for verdict, rule in urls.RULES:
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, best


def judged(spark, rows, **options):
    df = spark.createDataFrame([(i, u, "<p>", 1, "x") for i, u in rows], SCHEMA)
    got = urls.judge_urls(df, **options).collect()
    assert all(r.rest.html == "<p>" and r.rest.host == 1 for r in got)
    return got


def sites(seed, n):
    rng = random.Random(seed)
    good = ["therin", "ththan", "blog.ther", "www.tion"]
    bad = ["cheap-pills", "www.casino-win", "free-bets", "m.spam-farm"]
    out = []
    for i in range(n):
        host = rng.choice(bad if rng.random() < 0.3 else good) + ".example." + rng.choice(["com", "net", "org", "ORG"])
        tail = rng.choice(["", "?page=2&ref=x", "#top", "/"])
        out.append((i, f"http{rng.choice(['', 's'])}://{host}/{rng.choice(['en', 'de', 'fr'])}/{rng.randrange(999)}{tail}"))
    return out


def test_parts_and_rules_equal_definition(spark):
    odd = [None, "", "no scheme", "http://", "http://net", "http://net/", "http://NET/x", "http://a.net?x=/y", "x://y://example.net/en/", "ftp://example.net/en", "http://example.net/en/?q",
           "http://notexample.net/en/1", "http://example.com/de/\n1", "http://a.b.org/fr/#f", "http://org/fr/", "http://orgfr/", "://org/fr/x", "http://é.org/fr/", "http://a" + "b" * 100_000 + ".net/"]
    rows = [*enumerate(odd, 10_000), *sites(1, 300), (None, "http://x.net/"), (5, "http://x.net/")]
    got = judged(spark, rows)
    assert len(got) == len(rows)
    want = sorted((str(i), *brute(u)[:2], brute(u)[2][0] if brute(u)[2] else None) for i, u in rows)
    assert sorted((str(r.id), r.host, r.path, r.rule) for r in got) == want
    for r in got:
        assert r.verdict in ("allow", "block")
        if r.rule:
            assert r.verdict == dict((b, a) for a, b in urls.RULES)[r.rule]
        elif not r.host:
            assert r.verdict == "allow"


def test_trees_judge_unseen_hosts_by_shape(spark):
    train = sites(2, 500)
    new = [(9000, "http://fast-kredit.example.com/en/1"), (9001, "http://thereou.example.com/en/1")]
    got = {r.id: r for r in judged(spark, train + new)}
    free = [(i, u) for i, u in train if not brute(u)[2]]
    right = sum((got[i].verdict == "block") == any(w in u for w in ("pills", "casino", "bets", "spam")) for i, u in free)
    assert right / len(free) > 0.97
    assert got[9000].verdict == "block" and got[9001].verdict == "allow"
    again = {r.id: r.verdict for r in judged(spark, (train + new)[::-1])}
    assert again == {i: r.verdict for i, r in got.items()}


def test_one_label_or_none(spark):
    assert judged(spark, []) == []
    assert [r.verdict for r in judged(spark, [(1, "http://a.example.com/x"), (2, None)])] == ["allow", "allow"]
    assert {r.id: r.verdict for r in judged(spark, [(1, "http://casino.example.com/x"), (2, None)])} == {1: "block", 2: "allow"}
