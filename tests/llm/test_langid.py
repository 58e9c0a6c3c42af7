import itertools
import tracemalloc
import zlib

import numpy as np
import pytest

from eventlake.llm import langid

SCHEMA = "doc_id long, text string, lang string, score string, rest int"


def test_marginals_equal_sums_over_all_paths():
    rng = np.random.default_rng(1)
    labels, counts = 3, np.array([4, 0, 1, 6])
    e = rng.random((11, labels))
    move = rng.random((labels, labels)) + 0.1
    langid_chunk = langid.CHUNK
    try:
        for langid.CHUNK in (2, 3, 32):
            got = langid.marginals(e.copy(), counts, move)
            at = 0
            for n in counts[counts > 0]:
                want = np.zeros((n, labels))
                for path in itertools.product(range(labels), repeat=int(n)):
                    w = move[:, path[0]].sum() * e[at, path[0]]
                    for t in range(1, n):
                        w *= move[path[t - 1], path[t]] * e[at + t, path[t]]
                    for t in range(n):
                        want[t, path[t]] += w
                want /= want.sum(axis=1, keepdims=True)
                assert np.allclose(got[at : at + n], want)
                at += n
    finally:
        langid.CHUNK = langid_chunk


def test_training_sums_equal_sums_over_all_paths(monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_BLOCK", 6)  # blocks of two sequences
    rng = np.random.default_rng(4)
    labels, length, sequences, words = 3, 4, 5, 7
    e, move = rng.random((words, labels)) + 0.1, rng.random((labels, labels)) + 0.1
    pick, target = rng.integers(words, size=(length, sequences)), rng.integers(labels, size=(length, sequences))
    per_word, moved = np.zeros((words, labels)), np.zeros((labels, labels))
    for s in range(sequences):
        paths = list(itertools.product(range(labels), repeat=length))
        weigh = lambda y: move[:, y[0]].sum() * np.prod([e[pick[t, s], y[t]] for t in range(length)]) * np.prod([move[y[t - 1], y[t]] for t in range(1, length)])  # noqa: E731, B023
        z = sum(map(weigh, paths))
        for y in paths:
            for t in range(length):
                per_word[pick[t, s], y[t]] += weigh(y) / z
            for t in range(1, length):
                moved[y[t - 1], y[t]] += weigh(y) / z
        for t in range(length):
            per_word[pick[t, s], target[t, s]] -= 1
    got = langid.expected(e, pick, target, move)
    assert np.allclose(got[0], per_word) and np.allclose(got[1], moved)


def test_training_memory_grows_with_the_labels_only(monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 1)
    rng = np.random.default_rng(2)
    peak = {}
    for labels in (20, 60):
        samples = {f"l{i:02}": [" ".join(f"x{i}y{rng.integers(30)}" for _ in range(60)) for _ in range(3)] for i in range(labels)}
        tracemalloc.start()
        langid.train(samples)
        peak[labels] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert peak[60] < 500e6 and peak[60] < 3.5 * peak[20]


def test_held_out_accuracy_and_reruns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.id: r for r in langid.identify(docs).collect()}
    rows = docs.collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 100
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got == {r.id: r for r in langid.identify(docs).collect()}


def test_code_switched_text_is_labelled_in_runs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    parts = {lang: " ".join(docs.where(f"lang = '{lang}'").first().text.split()[:30]) for lang in ("en", "fr")}
    mixed = spark.createDataFrame([(-1, parts["en"] + " " + parts["fr"], None, "x", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    r = langid.identify(docs.unionByName(mixed), runs=True).where("id = -1").first()
    long = [x.lang for x in r.runs if x.end - x.start >= 10]
    assert long[:1] == ["en"] and long[-1:] == ["fr"]


def test_edge_rows(spark):
    base = [(i, ("the cat and dog " if i % 2 else "der hund und katze ") * 5, "en" if i % 2 else "de", None, None) for i in range(60)]
    odd = [
        (100, None, "en", None, 1), (101, "", "en", None, 1), (102, "12 + 34 !", "de", None, 1), (None, "the cat", None, None, 1),
        (103, "der hund " * 40_000, None, None, 1), (104, "x" * 300_000, None, None, 1), (1, base[1][1], "en", None, None),
    ]
    out = langid.identify(spark.createDataFrame(base + odd, SCHEMA)).collect()
    assert len(out) == len(base) + len(odd)
    pred = {r.id: r.lang_pred for r in out}
    assert [pred[k] for k in (100, 101, 102)] == ["und"] * 3
    assert pred[None] == "en" and pred[103] == "de" and pred[104] in ("de", "en")
    assert all(r.score == 0 for r in out if r.lang_pred == "und")


def test_nothing_to_learn_from(spark):
    assert langid.identify(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = langid.identify(spark.createDataFrame([(1, "the cat", None, None, 1)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]


def test_large_languages_are_still_drawn_from(spark, monkeypatch):
    for n in (1, 300, 301, 10**9, 10**13):
        assert 0 <= langid.largest_draw(n) < 2**63
        assert abs((langid.largest_draw(n) + 1) / 2**63 * n - min(n, 300)) < 1
    rows = [(i, ("the cat and dog " if i % 2 else "der hund und katze ") * 5, "en" if i % 2 else "de", None, 1) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(langid, "largest_draw", lambda n: -1)
    with pytest.raises(ValueError, match="de.*en"):
        langid.identify(docs)
