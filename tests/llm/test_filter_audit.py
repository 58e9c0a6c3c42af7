import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import filter_audit as fa

SCHEMA = "doc_id long, text string, source string, part int, mask string, h int"
SPACE = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, labels):
    """Every order applied to every row, one after the other."""
    fails = []
    for i, text, *_ in rows:
        t = text or ""
        w = SPACE.findall(t)
        mine = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, *_ in rows),
        }
        fails.append(mine)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for order in permutations("ABCDE"):
        alive = [True] * len(rows)
        for step, f in enumerate(order, 1):
            for k, (i, _, source, *_) in enumerate(rows):
                c = out.setdefault((source or "", "".join(order), step), Counter())
                failing = fails[k][f]
                if failing and not alive[k]:
                    c["redundant"] += 1
                if failing and sum(fails[k].values()) == 1:
                    c["unique_fails"] += 1
                if failing and alive[k]:
                    c["removed"] += 1
                    c["good_lost"] += i in good
                    c["toxic_lost"] += i in toxic
                    alive[k] = False
                c["kept"] += alive[k]
    total = Counter()
    for (part, order, step), c in out.items():
        total[part, order[step - 1]] += c["removed"]
    return {k: tuple(c[x] for x in fa._COUNTS[:-1]) + (total[k[0], k[1][k[2] - 1]],) for k, c in out.items()}


def result(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, "m", 2) for r in rows], SCHEMA)
    got = fa.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[c] for c in fa._COUNTS) for r in got}
    assert len(out) == len(got)
    return out


def test_audit_equals_definition(spark):
    rng = random.Random(5)
    texts = [None, "", " \n", "A", "#", "a " * 300, "B c " * 200, " ".join(map(str, range(250))), " ".join(f"x{i}" for i in range(250)) + " $"]
    rows = [(i, rng.choice(texts) if rng.random() < 0.7 else f"own text {i}", rng.choice(["s", "t", "", None])) for i in range(60)]
    # repeated rows, a NULL id, an id with two texts, a very long text twice
    long = "Word and word " * 60_000
    rows += [rows[3], rows[3], (None, "A", "s"), (None, "", None), (7, "another", "t"), (100, long, "u"), (101, long, "u")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 110, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    assert result(spark, rows, labels) == brute(rows, labels)


def test_empty_table(spark):
    assert result(spark, [], [(1, 1, 1)]) == {}


def test_copies_stay_possible_and_most_others_do_not(spark):
    n = 20_000
    hashes = spark.range(n).select(F.xxhash64(F.when(F.col("id") % 10 == 0, F.lit(-1)).otherwise(F.col("id"))).alias("h")).repartition(7)
    test = fa.repeats_test(hashes, n)
    rows = hashes.select("h", test("h").alias("possible")).collect()
    seen = Counter(r.h for r in rows)
    assert all(r.possible for r in rows if seen[r.h] > 1)
    cleared = sum(not r.possible for r in rows if seen[r.h] == 1)
    assert cleared > 0.97 * sum(v == 1 for v in seen.values())


def test_a_full_sketch_clears_nothing_and_loses_nothing(spark, monkeypatch):
    """Beyond the bound every text may be a repeat; results stay the same."""
    monkeypatch.setattr(fa, "FEWEST", 1 << 16)
    monkeypatch.setattr(fa, "MOST", 1 << 16)
    monkeypatch.setattr(fa, "PER_TEXT", 1)
    rows = [(i, f"t{i % 900}", "s") for i in range(1000)]
    got = result(spark, rows, [(1, 1, 1)])
    assert got["s", "EABCD", 1][1] == 100


def test_sketches_add_up():
    """Merged in any split, counters are those of all hashes, to 2."""
    h = np.arange(5000, dtype=np.int64) * 7919
    at = np.sort(fa.probes(np.concatenate([h, h[:100]]), 1 << 16), axis=0)
    fresh = np.ones(at.shape, dtype=bool)
    fresh[1:] = at[1:] != at[:-1]
    want = np.minimum(np.bincount(at[fresh], minlength=1 << 16), 2)
    run = fa.sketch(1 << 16)
    batch = lambda x: fa.pa.RecordBatch.from_arrays([fa.pa.array(x)], names=["h"])
    parts = [v for x in (h[:2000], h[2000:], h[:100]) for b in run([batch(x)]) for v in b["counts"].to_pylist()]
    assert np.array_equal(fa.merged(parts), want)


def test_filters_are_checked(spark):
    with pytest.raises(ValueError):
        fa.audit(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int"), filters={"E": fa.FILTERS["A"]})
