import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import tokens

SCHEMA = "doc_id long, text string, rest int, sections string"


def brute(text, parts, rule, encoding):
    """Byte by byte: the section of each, token after token."""
    b = (text or "").encode()
    owner = [None] * len(b)
    for k, (a, e) in enumerate(parts):
        owner[a:e] = [k] * (e - a)
    out, at, crossing, outside = [0.0] * len(parts), 0, 0, 0.0
    ids = encoding.encode_ordinary(text or "")
    assert b"".join(encoding.decode_single_token_bytes(i) for i in ids) == b
    for i in ids:
        n = len(encoding.decode_single_token_bytes(i))
        mine = owner[at : at + n]
        edges = {x for p in parts if p[0] < p[1] for x in p}
        crossing += any(at < x < at + n for x in edges)
        if rule == "start":
            mine = mine[:1]
        elif rule == "majority":
            runs = [(mine[:1], 0)]
            segments, last = [], object()
            for j, o in enumerate(mine):
                if o != last or (at + j) in edges and j:
                    segments.append([o, 0])
                    last = o
                segments[-1][1] += 1
            mine = [max(segments, key=lambda s: s[1])[0]]
            del runs
        for o in mine:
            if o is None:
                outside += 1 / len(mine)
            else:
                out[o] += 1 / len(mine)
        at += n
    return len(ids), crossing, [round(x, 6) for x in out], round(outside, 6)


@pytest.mark.parametrize("rule", tokens.RULES)
def test_sections_equal_definition(spark, rule):
    encoding, _ = tokens.encoder(tokens.VOCABULARY)
    rng = random.Random(1)
    vocab = ["the", " the", "über", "日本語", "\n", "  ", "12345", "!?", "é", "word"]
    rows, want = [], {}
    for i in range(60):
        text = "".join(rng.choice(vocab) for _ in range(rng.randrange(30)))
        cuts = sorted(rng.randrange(len(text) + 1) for _ in range(2 * rng.randrange(4)))
        spans = [(f"s{k}", cuts[2 * k], cuts[2 * k + 1]) for k in range(len(cuts) // 2)]
        rows.append((i, text, [{"name": n, "start": a, "end": b} for n, a, b in spans]))
        at = lambda x: len(text[:x].encode())  # noqa: B023, E731
        want[i] = brute(text, [(at(a), at(b)) for _, a, b in spans], rule, encoding)
    df = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<name: string, start: int, end: int>>")
    for r in tokens.count_tokens(df, sections=F.col("spans"), rule=rule).collect():
        assert (r.n_tokens, r.n_crossing, [round(s.tokens, 6) for s in r.sections], round(r.outside, 6)) == want[r.id]


def test_lines_and_edge_rows(spark):
    encoding, _ = tokens.encoder(tokens.VOCABULARY)
    rows = [(1, None), (2, ""), (3, "\n"), (4, "a\n\nb"), (5, "one\n\n\n  two\n"), (5, "one\n\n\n  two\n"), (None, "x"), (6, "z" * 300_000), (7, "line of text\n" * 20_000), (8, "<|endoftext|>")]
    got = tokens.count_tokens(spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    by = dict(rows)
    for r in got:
        text = by[r.id] or ""
        assert r.rest.rest == 1 and r.rest.sections == "s"
        assert r.n_bytes == len(text.encode()) and r.n_tokens == len(encoding.encode_ordinary(text))
        assert sum(s.tokens for s in r.sections) == r.n_tokens and r.outside == 0
        assert len(r.sections) == len(text.splitlines())
    assert tokens.count_tokens(spark.createDataFrame([], SCHEMA)).collect() == []


def test_overlapping_sections_are_an_error(spark):
    df = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    spans = F.expr("array(named_struct('name', 'a', 'start', 0, 'end', 5), named_struct('name', 'b', 'start', 3, 'end', 6))")
    with pytest.raises(Exception, match="overlap"):
        tokens.count_tokens(df, sections=spans).collect()


def test_attribute_of_nothing():
    counts, crossing = tokens.attribute(np.zeros(0, dtype=np.int64), [], "start")
    assert len(counts) == 0 and crossing == 0
