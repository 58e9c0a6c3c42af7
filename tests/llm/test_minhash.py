import random
import re
from collections import Counter

import numpy as np

from eventlake.llm import minhash

SCHEMA = "doc_id long, text string, id string, node int"


def parts(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
    seen = Counter()
    out = []
    for g in grams:
        out.append((g, seen[g]))
        seen[g] += 1
    return out


def brute_similarity(x, y):
    """By the full alignment table."""
    row = [0] * (len(y) + 1)
    for a in x:
        up = row[:]
        for j, b in enumerate(y):
            row[j + 1] = up[j] + 1 if a == b else max(row[j], up[j + 1])
    return row[-1] / (len(x) + len(y) - row[-1]) if x and y else 0.0


def brute(rows):
    x = [parts(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if x[i] and x[j] and brute_similarity(x[i], x[j]) >= 0.8:
                group[root(i)] = root(j)
    first = {}
    for i, (d, _) in enumerate(rows):
        key = (d is None, d or 0)
        first[root(i)] = min(first.get(root(i), key), key)
    return [first[root(i)] for i in range(len(rows))]


def corpus(seed, n=60):
    rng = random.Random(seed)
    text = lambda k: " ".join("w%d" % rng.randrange(3000) for _ in range(k))
    passage, rows = text(40), []
    for _ in range(n):
        kind = rng.random()
        if rows and kind < 0.5:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(w) + 1)
                w[at : at + rng.randrange(2)] = [text(1)] * rng.randrange(2)
            t = " ".join(w)
        elif kind < 0.7:
            t = text(30) + " " + passage + " " + text(30)
        else:
            t = text(rng.randrange(40, 150))
        rows.append((len(rows) * 7 % 1000, t))
    return rows


def classes(spark, rows):
    got = minhash.near_duplicates(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    return got


def test_similarity_equals_full_alignment():
    rng = random.Random(1)
    for _ in range(200):
        x = [rng.randrange(12) for _ in range(rng.randrange(1, 40))]
        y = x[:]
        for _ in range(rng.randrange(6)):
            y[rng.randrange(len(y) + 1) :][: rng.randrange(2)] = []
            y.insert(rng.randrange(len(y) + 1), rng.randrange(12))
        lab = lambda s: minhash.labelled(np.array(s, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        a, b = lab(x), lab(y)
        want = brute_similarity(a.tolist(), b.tolist())
        assert abs(minhash.similarity(a, b) - (want if want >= 0.8 else 0)) < 1e-12


def test_groups_equal_all_pairs(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        got = {r.id: r.class_id for r in classes(spark, rows)}
        assert [got[d] for d, _ in rows] == [k[1] for k in brute(rows)]


def test_buckets_full_of_strangers_are_split(spark, monkeypatch):
    # the first bands put everything into one bucket, as a shared passage would
    real = minhash.bands
    monkeypatch.setattr(minhash, "bands", lambda x: np.concatenate((np.arange(3, dtype=np.int64), real(x)[3:])))
    rng = random.Random(3)
    text = lambda k: " ".join("w%d" % rng.randrange(9000) for _ in range(k))
    rows = []
    for i in range(12):
        base = text(80)
        rows += [(2 * i, base), (2 * i + 1, base + " end")]
    got = {r.id: r.class_id for r in classes(spark, rows)}
    assert got == {i: i // 2 * 2 for i in range(24)}


def test_recall_in_a_swarm_of_edited_copies(spark):
    # copies of one base whose similarities to each other lie around the threshold
    rng = random.Random(8)
    base = ["w%d" % rng.randrange(9000) for _ in range(120)]
    rows = []
    for i in range(80):
        w = base[:]
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = "x%d" % rng.randrange(9000)
        rows.append((i, " ".join(w)))
    got = {r.id: r.class_id for r in classes(spark, rows)}
    want = [k[1] for k in brute(rows)]
    assert sum(got[i] == c for i, c in enumerate(want)) >= 0.98 * len(rows)


def test_star_of_copies_unlike_each_other(spark):
    # every copy is similar to the base and to no other copy, so that only the base ties them
    rng = random.Random(5)
    base = ["w%d" % rng.randrange(90_000) for _ in range(120)]
    rows = [(1000, " ".join(base))]
    for i in range(1000):
        w = base[:]
        for lo in (5, 65):
            w[lo + rng.randrange(45)] = "x%d" % rng.randrange(10**9)
        rows.append((i, " ".join(w)))
    x = minhash.shingles([t.encode() for _, t in rows])
    assert all(minhash.similarity(x[0], y) >= 0.8 for y in x[1:])
    assert sum(minhash.similarity(x[1], y) > 0 for y in x[2:]) < 50
    assert {r.class_id for r in classes(spark, rows)} == {0}


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(2)
    for n in (1, 16, 17, 300):
        x = minhash.labelled(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.concatenate((x[n // 4 :], rng.integers(0, 2**63, n // 5).astype(np.uint64)))
        a, b = (np.frombuffer(minhash.parity(v), np.uint8) for v in (x, y))
        while len(a) != len(b):
            a, b = ((v[: len(v) // 2] ^ v[len(v) // 2 :] if len(v) == max(len(a), len(b)) else v) for v in (a, b))
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))


def test_components_of_chains_and_rings(spark):
    key = lambda i: i.to_bytes(4, "big")
    chain = [(key(i), key(i + 1)) for i in range(60)] + [(key(100 + i), key(100 + (i * 7 + 8) % 31)) for i in range(31)]
    random.Random(1).shuffle(chain)
    links = spark.createDataFrame(chain, "a binary, b binary")
    got = {int.from_bytes(r.node, "big"): int.from_bytes(r.comp, "big") for r in minhash.components(links).collect()}
    assert {got[i] for i in range(61)} == {0} and len(got) == 61 + len({x for a, b in chain for x in (a, b) if x >= key(100) and a != b})
    assert minhash.components(links.limit(0)).count() == 0


def test_edge_rows(spark):
    a = " ".join(f"t{i}" for i in range(60))
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, "?!"), (6, "?!"), (7, "one two"), (8, "One, two"), (9, a), (9, a), (None, a), (10, a + " x"), (11, "y " * 200_000), (12, "y " * 199_000), (None, None)]
    got = sorted(((r.id is None, r.id or 0, r.class_id, r.class_size) for r in classes(spark, rows)), key=str)
    by = {}
    for null, i, c, n in got:
        by.setdefault(None if null else i, []).append((c, n))
    for i in range(1, 7):
        assert by[i] == [(i, 1)]
    assert by[7] == by[8] == [(7, 2)]
    assert by[9] == [(9, 4)] * 2 and by[10] == [(9, 4)] and (9, 4) in by[None] and (None, 1) in by[None]
    assert by[11] == by[12] == [(11, 2)]
    kept = minhash.keep_one(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    assert sorted((str(r.doc_id), r.text and r.text[:7], r.id, r["node"]) for r in kept) == sorted(
        [("1", None, "x", 1), ("2", None, "x", 1), ("3", "", "x", 1), ("4", "", "x", 1), ("5", "?!", "x", 1), ("6", "?!", "x", 1), ("7", "one two", "x", 1), ("9", a[:7], "x", 1), ("11", "y y y y", "x", 1), ("None", None, "x", 1)], key=str
    )


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert minhash.near_duplicates(df).collect() == [] == minhash.keep_one(df).collect()
