import random
import re

import pytest

from eventlake.llm.decontaminate import WINDOW, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            x = words(t)
            m = min(WINDOW, len(x))
            grams = {tuple(x[i : i + m]) for i in range(len(x) - m + 1)} if m else set()
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in grams:
                    hit |= set(range(i, i + m))
                    if item is not None:
                        found.add(str(item))
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, items string, `a.b` int")
    b = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, extra int")
    got = decontaminate(d, b, **options).collect()
    assert all(r.rest["items"] == "x" and r.rest["a.b"] == 1 for r in got)
    return sorted(((r.id, r.n_words, sum(s.end - s.start for s in r.spans), r["items"]) for r in got), key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 900])
def test_equals_definition(spark, block_bytes):
    rng = random.Random(5)
    vocab = ["The", "on", "é", "über", "x1", "日本", "a" * 70, "K"]
    items = [(i, " ".join(rng.choice(vocab) + str(rng.randrange(9)) for _ in range(rng.choice([1, 2, 5, 12, 13, 14, 30])))) for i in range(20)]
    items += [(3, items[4][1].upper()), (None, items[8][1] + " more"), (50, ""), (51, None), (52, "..."), (53, items[5][1])]
    docs = [(0, None), (1, ""), (2, "?!"), (None, items[6][1] or "")]
    for i in range(60):
        t = " ".join(rng.choice(vocab) + str(rng.randrange(9)) for _ in range(rng.randrange(50)))
        if rng.random() < 0.6:
            p = words(rng.choice(items)[1])
            a = rng.randrange(len(p) + 1) if p else 0
            t += ", " + " - ".join(p[a : a + rng.randrange(12, 20)]) + ";" + t[:50]
        docs.append((i, t))
    docs += [docs[10], docs[10]]
    assert run(spark, docs, items, block_bytes=block_bytes) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, [])]


def test_very_long_text(spark):
    text = "lorem " * 200_000 + "one two three four five six seven eight nine ten eleven twelve thirteen"
    assert run(spark, [(1, text), (2, "w" * 1_000_000)], [(1, text[-71:])]) == [(1, 200_013, 13, ["1"]), (2, 1, 0, [])]
