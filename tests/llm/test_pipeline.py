"""The whole pipeline against a brute-force version over a small corpus."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventlake.llm.mixing import targets

from test_decontaminate import brute as contamination
from test_minhash import brute as groups
from test_suffix_dedup import sd

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(12)
    vocab = {"en": ["the", "of", "thing", "and", "house"], "fr": ["le", "été", "maison", "où", "garçon"]}
    text = lambda lang, n: " ".join(rng.choice(vocab[lang]) + "abcdefghij"[rng.randrange(10)] * rng.randrange(4) for _ in range(n))
    benchmark = [(i, text("en", 20)) for i in range(4)]
    passage = text("fr", 55)
    docs = []
    for i in range(70):
        lang = rng.choice(["en", "fr"])
        kind = rng.random()
        t = text(lang, rng.randrange(30, 90))
        if docs and kind < 0.2:
            t, lang = rng.choice(docs)[1:3]
            t = (t or "x") + rng.choice(["", " end"])
        elif kind < 0.35:
            t = t + "\n" + passage + "\n" + text(lang, 20)
        elif kind < 0.45:
            t = t[:60] + " " + rng.choice(benchmark)[1]
        docs.append((i, t, lang, rng.choice(["a", "b", None]), len(t)))
    docs += [(100, None, "en", "a", 0), (101, "", "en", "a", 0), (102, "12 34", "fr", "b", 5), (103, "?!", None, None, 2)]
    return docs, benchmark


def cut(rows):
    first = {}
    for d, t in rows:
        b = t.encode()
        for i in range(len(b) - sd.SPAN + 1):
            w = b[i : i + sd.SPAN]
            first[w] = min(first.get(w, d), d)
    out = {}
    for d, t in rows:
        b = t.encode()
        gone = set()
        for i in range(len(b) - sd.SPAN + 1):
            if first[b[i : i + sd.SPAN]] < d:
                gone |= set(range(i, i + sd.SPAN))
        at, kept = 0, []
        for c in t:
            n = len(c.encode())
            if not gone & set(range(at, at + n)):
                kept.append(c)
            at += n
        out[d] = "".join(kept)
    return out


@pytest.fixture(scope="module")
def sf_dir(spark):
    docs, benchmark = corpus()
    folder = "file://" + tempfile.mkdtemp(prefix="corpus-")
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_run_equals_brute_force(spark, sf_dir):
    docs, benchmark = corpus()
    rows = [(d, t) for d, t, *_ in docs if t and any(c.isalpha() for c in t)]
    rows = [r for r, g in zip(rows, groups(rows), strict=True) if r[0] == g[1]]
    left = cut(rows)
    dirty = {d for d, n, hit, _ in contamination(list(left.items()), benchmark) if hit and 20 * hit >= n}
    kept = {d: t for d, t in left.items() if d not in dirty}
    assert dirty and len(kept) < len(rows) < 70

    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert {d: r["size"] for d, r in got.items()} == {d: len(t.split()) for d, t in kept.items()}
    source = {d: s for d, _, _, s, _ in docs}
    sizes, taken = {}, {}
    for d, r in got.items():
        sizes[source[d]] = sizes.get(source[d], 0) + r["size"]
        taken[source[d]] = taken.get(source[d], 0) + r.taken
        assert 0 <= r.taken <= 2 * r["size"]
    assert taken == {s: round(t) for s, t in targets(sizes).items()}


def test_stages_keep_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    schema = [(f.name, f.dataType) for f in docs.schema]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert [(f.name, f.dataType) for f in out.schema] == schema, name
    cutted = corpus_pipeline.substring_dedup(spark, docs, sf_dir)
    assert cutted.where(F.col("n_chars") != F.length("text")).count() == 0


def test_an_empty_table(spark):
    folder = "file://" + tempfile.mkdtemp(prefix="corpus-")
    spark.createDataFrame([], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_ends_in_a_corpus_of_whole_texts(spark, sf_dir):
    """Repeated ids, a very long text, a missing language and extra columns."""
    docs, benchmark = corpus()
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    long = " ".join(word() for _ in range(60_000))
    rows = [(*r, 1, "r") for r in docs]
    rows += [(200, long, None, "a", len(long), 2, "x"), (201, "the house and thing of the house " + word(), "fr", "b", 1, 3, None)]
    twice = [" ".join(word() for _ in range(40)) for _ in range(2)]
    rows += [(300, t, "en", "b", 9, 4, "y") for t in twice] + [rows[0], rows[0]]
    folder = "file://" + tempfile.mkdtemp(prefix="corpus-")
    spark.createDataFrame(rows, COLUMNS + ", size int, rest string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "rest", "size", "source_size", "target", "taken"]
    got = out.collect()
    ids = [r.doc_id for r in got]
    assert sorted(ids) == sorted([*set(ids), 300]) and ids.count(300) == 2
    assert sorted(r.text for r in got if r.doc_id == 300) == sorted(twice)
    one = {r.doc_id: r for r in got}
    assert one[200].text == long and one[200].lang in ("en", "fr") and one[200]["rest"] == "x"
    assert all(r["size"] == len(r.text.split()) and r.n_chars == len(r.text) and r.lang for r in got)
    taken, size = {}, {}
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        size[r.source] = size.get(r.source, 0) + r["size"]
    assert taken == {s: round(t) for s, t in targets(size).items()}


def test_language_decisions_reach_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fr = [r.doc_id for r in docs.where("lang = 'fr' and length(text) > 500").orderBy("doc_id").limit(4).collect()]
    wrong = docs.withColumn("lang", F.when(F.col("doc_id").isin(fr[:2]), None).when(F.col("doc_id").isin(fr[2:]), "en").otherwise(F.col("lang")))
    got = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, wrong, "").collect()}
    assert [got[d] for d in fr] == ["fr"] * 4
    own = {r.doc_id: r.lang for r in docs.collect()}
    assert sum(got[d] == own[d] for d in got) / len(got) > 0.97
