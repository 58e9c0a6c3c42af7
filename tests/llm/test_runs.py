import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlake.llm import runs
from eventlake.llm.queries import op13_runs

SCHEMA = "doc_id long, text string, runs string, id int, collapsed string"


def brute(w, min_length=6, min_exponent=4):
    """Every maximal stretch of every period; smaller periods first."""
    out = []
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i + q - s
            smallest = next(d for d in range(1, q + 1) if all(w[s + k] == w[s + k + d] for k in range(n - d)))
            if n >= max(min_length, min_exponent * q) and smallest == q:
                out.append((s, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


words = st.lists(st.sampled_from("abc"), max_size=24)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(words, st.lists(st.sampled_from("ab"), min_size=1, max_size=5), st.integers(0, 7), words), min_size=1, max_size=4), st.sampled_from([(3, 2), (6, 3), (6, 4)]))
def test_runs_equal_definition(parts, least):
    texts = [a + root * k + b for a, root, k, b in parts]
    split, rows = runs.find_runs([" \n".join(w).encode() for w in texts], *least)
    text = runs.collapse(split, rows, len(texts)).to_pylist()
    for i, w in enumerate(texts):
        found = [tuple(r[1:].tolist()) for r in rows if r[0] == i]
        assert found == brute(w, *least)
        assert text[i] == collapsed(w, found)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=40), st.data())
def test_extensions_equal_definition(text, data):
    text = [x + 1 for x in text] + [0]
    a = data.draw(st.integers(0, len(text) - 1))
    b = data.draw(st.integers(0, len(text) - 1).filter(lambda x: x != a))
    n = 0
    while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
        n += 1
    got = runs.Extensions(text, 4)(runs.np.array([a]), runs.np.array([b]))
    assert got.tolist() == [n]
    suffixes, _ = runs.tour(text, 4)
    assert suffixes.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_trees_are_cut_by_words(monkeypatch):
    """Stretches dealt to many trees give the same runs."""
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") for _ in range(200)).encode() for _ in range(20)]
    whole = runs.find_runs(texts, 6, 4)[1].tolist()
    monkeypatch.setattr(runs, "TREE_WORDS", 50)
    assert runs.find_runs(texts, 6, 4)[1].tolist() == whole != []


def test_edge_rows(spark):
    long = "x y z " * 40_000
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, "a a a a a a"), (5, "a a a a a a"), (None, "b " * 9), (6, long), (7, "w" * 200_000), (8, "A a A a A a A a"), (9, "é é é é é é é é é é é é")]
    df = spark.createDataFrame([(*r, "n", 7, "c") for r in rows], SCHEMA)
    got = {}
    out = runs.periodic_runs(df).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.rest.runs, r.rest.id, r.rest.collapsed) == ("n", 7, "c")
        got[r.id] = (r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed)
    assert got[1] == got[2] == got[3] == (0, [], "")
    assert got[4] == (5, [], "a a a a a")
    assert got[5] == (6, [(0, 6, 1)], "a")
    assert got[None] == (9, [(0, 9, 1)], "b")
    assert got[6] == (120_000, [(0, 120_000, 3)], "x y z")
    assert got[7] == (1, [], "w" * 200_000)
    assert got[8] == (8, [(0, 8, 2)], "A a")
    assert got[9] == (6, [(0, 6, 1)], "é é")
    assert runs.periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        runs.periodic_runs(df, min_exponent=1)


def planted(doc_id, text):
    w = [x for x in runs.np.char.split(text.translate({c: " " for c in runs.SPACES}), " ").item() if x] if text else []
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_query_equals_brute_force(spark):
    """The whole small table, texts of up to 1,200 words by the definition."""
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op13_runs(spark, d).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert len(got) == len(docs)
    tested = with_runs = 0
    for r in docs:
        w = planted(r.doc_id, r.text)
        if len(w) > 1200:
            continue
        found = brute(w)
        q = got[r.doc_id]
        best = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (q.n_runs, q.start, q.length, q.period, q.exponent_milli) == (len(found), *want)
        assert q.runs_sha256 == sha("".join(f"{s},{n},{p}\n" for s, n, p in found))
        assert q.collapsed_sha256 == sha(collapsed(w, found))
        tested += 1
        with_runs += bool(found)
    assert tested > 150 and with_runs > 5


def test_tails_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e f g h", 1), (14, None, 2), (14, " ", 3)], "doc_id long, text string, __n int")
    assert [tuple(r) for r in runs.repeat_tails(df.drop("__n")).collect()] == [(None, "a b c d e f g h"), (14, None), (14, " ")]
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    text = " ".join(f"w{i}" for i in range(50))
    rows = spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string")
    for r in runs.repeat_tails(rows).collect():
        assert r.text.split() == planted(r.doc_id, text)
    assert runs.repeat_tails(rows.withColumn("extra", F.lit(1))).columns == ["doc_id", "text", "extra"]
