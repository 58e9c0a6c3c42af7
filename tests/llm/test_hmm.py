import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import hmm
from eventlake.llm.queries import op11_hmm_score

SCHEMA = "doc_id long, text string, rest string, id int, score string"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def model(classes, seed=1):
    draw = np.random.default_rng(seed)
    k = hmm.STATES
    return hmm.Model(draw.dirichlet(np.ones(k)), draw.dirichlet(np.ones(k), k), draw.dirichlet(np.ones(classes), k).T.copy())


def forward_backward(m, seq):
    """Unscaled, one text, place by place."""
    ahead = [m.first * m.emit[seq[0]]]
    for c in seq[1:]:
        ahead.append((ahead[-1] @ m.move) * m.emit[c])
    back = [np.ones(hmm.STATES)]
    for c in seq[:0:-1]:
        back.append(m.move @ (m.emit[c] * back[-1]))
    back, total = back[::-1], ahead[-1].sum()
    emits, moves = np.zeros(m.emit.shape), np.zeros(m.move.shape)
    for c, a, b in zip(seq, ahead, back, strict=True):
        emits[c] += a * b / total
    for t in range(1, len(seq)):
        moves += ahead[t - 1][:, None] * m.move * (m.emit[seq[t]] * back[t])[None, :] / total
    return math.log10(total), ahead[0] * back[0] / total, moves, emits


@pytest.mark.parametrize("piece", [3, 512])
def test_pieces_equal_definition(piece, monkeypatch):
    monkeypatch.setattr(hmm, "PIECE", piece)
    monkeypatch.setattr(hmm, "ABREAST", 4)
    m = model(7)
    sizes = np.array([1, 2, 3, 4, 7, 12, 1, 30, 6])
    classes = np.random.default_rng(2).integers(0, 7, sizes.sum()).astype(np.uint16)
    want = [forward_backward(m, classes[a : a + n]) for a, n in zip(np.cumsum(sizes) - sizes, sizes, strict=True)]
    pieces = hmm.Pieces(sizes, classes)
    assert np.allclose(pieces.likelihoods(m), [w[0] for w in want])
    first, moves, emits, total = pieces.expected(m)
    for got, k in ((first, 1), (moves, 2), (emits, 3)):
        assert np.allclose(got, sum(w[k] for w in want))
    assert np.isclose(total, sum(w[0] for w in want))


def test_likelihood_is_the_sum_over_all_paths():
    m = model(3)
    seq = [0, 2, 1, 1]
    paths = sum(
        m.first[p[0]] * m.emit[seq[0], p[0]] * math.prod(m.move[a, b] * m.emit[c, b] for a, b, c in zip(p, p[1:], seq[1:], strict=False))
        for p in itertools.product(range(hmm.STATES), repeat=len(seq))
    )
    assert np.isclose(hmm.Pieces(np.array([4]), np.array(seq, dtype=np.uint16)).likelihoods(m)[0], math.log10(paths))


def test_long_texts_do_not_underflow():
    m = model(5)
    classes = np.random.default_rng(3).integers(0, 5, 50_000).astype(np.uint16)
    got = hmm.Pieces(np.array([50_000]), classes).likelihoods(m)[0]
    x, want = m.first, 0.0
    for t, c in enumerate(classes):
        x = (x @ m.move if t else x) * m.emit[c]
        want += math.log10(x.sum())
        x = x / x.sum()
    assert np.isclose(got, want)


def test_rounds_raise_the_likelihood():
    """Texts by two speakers: each round fits better, and the states part them."""
    draw = np.random.default_rng(4)
    sizes = np.full(60, 40)
    classes = np.concatenate([draw.integers(0, 5, 40) + 5 * (i % 2) for i in range(60)]).astype(np.uint16)
    shares = np.full(10, 0.1)
    m, totals = hmm.Model.guess(shares), []
    for _ in range(8):
        first, moves, emits, total = hmm.Pieces(sizes, classes).expected(m)
        totals.append(total)
        m = hmm.Model.fit(shares, first, moves, emits)
    assert all(a < b for a, b in zip(totals, totals[1:], strict=False))
    assert totals[-1] / classes.size > -0.75 > -0.99 > totals[0] / classes.size


def base_columns(docs):
    """The definition of all columns but the model's score."""
    tokens, count = {}, Counter()
    for i, text in docs:
        tokens[i] = [*WORD.findall((text or "").translate(LOWER)), None]
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(tokens[i])
    n, v = sum(count.values()), len(count)
    return {i: (len(t), sum(count[x] > 0 for x in t), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t)) for i, t in tokens.items()}


def test_query_against_definition_and_held_out(spark):
    d = "/root/testdata/sf0.001"
    want = base_columns([(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()])
    rows = op11_hmm_score(spark, d).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.base_score == pytest.approx(want[r.doc_id][3], rel=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert r.score < 0
    unseen = [r for r in rows if r.held_out]
    assert len(unseen) > 10
    assert sum(r.score for r in unseen) > 1.03 * sum(r.base_score for r in unseen)
    assert sum(r.score > r.base_score for r in unseen) > 0.9 * len(unseen)


def test_blocks_and_buckets_do_not_change_results(spark, monkeypatch):
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randrange(40)))) for i in range(120)] + [(500, " ".join(rng.choices(vocab, k=3000)))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    held = F.col("doc_id") % 3 == 0
    whole = {r.id: r for r in hmm.score_texts(df, held_out=held, rounds=2).collect()}
    monkeypatch.setattr(hmm, "BUCKET_WORDS", 500)
    parts = {r.id: r for r in hmm.score_texts(df, held_out=held, rounds=2, block_bytes=900).collect()}
    for i, r in whole.items():
        q = parts[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (q.n_tokens, q.n_known, q.train_tokens, q.held_out)
        assert r.base_score == pytest.approx(q.base_score) and r.score == pytest.approx(q.score, abs=1e-3)
    again = {r.id: r.score for r in hmm.score_texts(df, held_out=held, rounds=2, block_bytes=900).collect()}
    assert again == {i: q.score for i, q in parts.items()}


def test_edge_rows(spark):
    long = "One two THREE four " * 30_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b a"), (4, "a b a"), (None, "never learned"), (5, long), (6, "x" * 100_000), (7, "É é A a"), (19, "only held out")]
    df = spark.createDataFrame([(*r, "n", 7, "c") for r in rows], SCHEMA)
    out = hmm.score_texts(df, rounds=1).collect()
    assert len(out) == len(rows) and all((r.rest.rest, r.rest.id, r.rest.score) == ("n", 7, "c") for r in out)
    # the repeated row counts twice
    count, tokens = Counter(), [[*WORD.findall((t or "").translate(LOWER)), None] for _, t in rows]
    for (i, _), t in zip(rows, tokens, strict=True):
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(t)
    n, v = sum(count.values()), len(count)
    want = sorted((i is None, i or 0, len(t), sum(count[x] > 0 for x in t)) for (i, _), t in zip(rows, tokens, strict=True))
    assert sorted((r.id is None, r.id or 0, r.n_tokens, r.n_known) for r in out) == want
    by = {r.id: r for r in out}
    assert by[1].n_tokens == 1 and by[1].score == pytest.approx(by[2].score) and by[3].score == pytest.approx(by[1].score)
    assert by[5].base_score == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in tokens[6]))
    assert all(np.isfinite(r.score) for r in out)
    assert hmm.score_texts(spark.createDataFrame([], SCHEMA), rounds=1).collect() == []


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for r in hmm.score_texts(df, held_out=F.lit(True), rounds=1).collect():
        assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and r.score < 0
