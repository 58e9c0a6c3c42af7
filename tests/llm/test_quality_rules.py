import random
import re
from collections import Counter

from pyspark.sql import functions as F

from eventlake.llm import quality

SCHEMA = "doc_id long, text string, words int, n_words string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(grams)
    covered = {k for i, g in enumerate(grams) if seen[g] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed


def judged(spark, rows, **options):
    got = quality.judge(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), **options).collect()
    assert all(r.rest.words == 1 and r.rest["n_words"] == "x" for r in got)
    return got


def test_counts_equal_definition(spark):
    rng = random.Random(1)
    rows = []
    for i in range(150):
        vocab = ["w%d" % k for k in range(rng.choice([2, 5, 40, 4000]))] + ["é#", "||", "\n", "\t", "a\rb", "日本", "\x0b", "x\n\n"]
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(rng.choice(vocab) for _ in range(rng.randrange(200)))))
    rows += [(-1, None), (-2, ""), (-3, " \n\t "), (-4, "one"), (-5, "a b"), (-6, "a b c " * 20_000), (-7, "w" * 200_000), (None, "null id"), (-8, " ".join(map(str, range(5000))) * 2), (-4, "one")]
    got = sorted(((str(r.id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in judged(spark, rows)))
    assert got == sorted((str(d), *brute(t)) for d, t in rows)


def test_rules_and_order(spark):
    good = " ".join("word%s" % chr(97 + i % 26) + chr(97 + i // 26) for i in range(200)) + "."
    bad = {
        "symbols": good.replace("w", "## w"),
        "capitals": good.upper(),
        "digits": re.sub("word", "1234w", good),
        "insults": good + " you idiot, idiot!",
        "placeholder": good + " Lorem ipsum.",
        "few_words_with_letters": good.replace("word", "- word"),
    }
    rows = [(0, good), *enumerate(bad.values(), 1), (20, "short")]
    got = {r.id: r for r in judged(spark, rows)}
    assert got[0].kept and got[0].rejected_by is None
    features = quality.with_plain(quality.with_features(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)))
    says = {r.id: r for r in features.select("id", *[rule().alias(name) for name, rule in quality.RULES.items()]).where("id < 20").collect()}
    for i, name in enumerate(bad, 1):
        assert says[i][name] and says[i][got[i].rejected_by]
    assert not any(says[0][name] for name in quality.RULES)
    assert not any(got[i].kept for i in (1, 2, 3, 4, 5, 6, 20)) and got[20].base_failed and got[20].rejected_by is None


def test_order_is_by_rejections_per_cost_and_short_circuits(spark):
    df = spark.createDataFrame([(i, "some words here", 1, "x") for i in range(300)], SCHEMA)
    rules = {
        "never": lambda: F.lit(False),
        "half": lambda: F.col("id") % 2 == 0,
        "all": lambda: F.col("id") >= 0,
        "costly_all": lambda: F.aggregate(F.sequence(F.lit(0), F.col("id") * 0 + 20_000), F.lit(0).cast("long"), lambda a, x: a + x % 7) >= 0,
    }
    order = quality.rule_order(df, "doc_id", "text", rules)
    assert order[-1] == "never" and order.index("all") < order.index("costly_all")
    # a rule after one that rejects isn't evaluated: this one would fail the query
    trap = {"all": rules["all"], "trap": lambda: F.raise_error(F.concat(F.lit("asked "), F.col("id"))).isNotNull()}
    rows = df.select(F.col("doc_id").alias("id")).select(quality.cascade(["all", "trap"], trap).alias("r"))
    assert [r.r for r in rows.distinct().collect()] == ["all"]


def test_toxic_words_are_learned_from_all_labels(spark):
    """Against plain counting over different texts; then the rule rejects by
    them, whatever stands around a word."""
    rng = random.Random(2)
    plain = lambda t: {w for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))}
    vocab = [f"wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows, labels = [], []
    for i in range(300):
        words = rng.choices(vocab, k=60)
        toxic = i % 5 == 0
        if toxic or i % 97 == 1:
            words[7:9] = ["Pfui!", "schändlich,"] if i % 2 else ["(pfui)", "PFUI"]
        rows.append((i, " ".join(words)))
        if i < 250:
            labels.append((i, int(toxic) if i % 11 else None))
    rows += [(1000, rows[0][1]), (1001, None), (1002, "only"), (None, "pfui pfui")]
    labels += [(1000, 1), (1001, 1), (0, 0), (7777, 1), (None, 1)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    by_id: dict = {}
    for i, t in labels:
        if t is not None:
            by_id[i] = max(t, by_id.get(i, 0))
    texts = {(t, by_id[i]) for i, t in rows if t is not None and i is not None and i in by_id}
    held = [Counter(w for t, x in texts if x == k for w in plain(t)) for k in (0, 1)]
    least = max(quality.TOXIC_LEAST, -(-sum(x for _, x in texts) // quality.TOXIC_ONE_IN))
    want = sorted(w for w, n in held[1].items() if n >= least and n >= quality.TOXIC_RATIO * held[0][w])
    words = quality.toxic_words(docs, marks)
    assert words == want and "schändlich" in words
    rules = quality.RULES | quality.toxic_rule(["pfui", "schändlich"])
    got = {r.id: r for r in judged(spark, [r for r in rows if r[0] is not None and r[0] >= 250], rules=rules)}
    for i in range(250, 300):
        bad = "pfui" in plain(rows[i][1])
        assert got[i].kept != bad and (got[i].rejected_by == "toxic_words") == bad
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert quality.toxic_words(docs, none) == [] and all(r.kept for r in judged(spark, [rows[1]], rules=quality.RULES | quality.toxic_rule([])) if r.id == 1)


def test_many_labels_are_shuffled_not_broadcast(spark, monkeypatch):
    """Beyond the bound no copy of the labels is broadcast; the words are the same."""
    docs = spark.range(900).selectExpr("id % 890 AS doc_id", "if(id % 9 = 0, 'Pfui ', 'gut ') || (id % 700) || ' rest' AS text")
    marks = spark.range(0, 900, 3).selectExpr("id AS doc_id", "if(id % 9 = 0, 1, if(id % 5 = 0, NULL, 0)) AS toxic")
    want, plans, stored = quality.toxic_words(docs, marks), {}, quality.stored

    def seen(df, name):
        out = stored(df, name)
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
        return out

    monkeypatch.setattr(quality, "stored", seen)
    monkeypatch.setattr(quality, "DEFAULT_MAX_BROADCAST_BYTES", 100, raising=False)
    monkeypatch.setattr("eventlake.plans.joins.fits", lambda df, most: False)
    monkeypatch.setattr(quality, "fits", lambda df, most: False, raising=False)
    assert quality.toxic_words(docs, marks) == want == ["pfui"]
    assert "SortMergeJoin [id" in plans["labelled"] and "BroadcastHashJoin [id" not in plans["labelled"]
    assert "SortMergeJoin [row" in plans["labelled-once"] + plans["toxic-words"] and "BroadcastHashJoin [row" not in plans["toxic-words"]


def test_draw_of_any_share(spark):
    """A sample of a huge table is small, not empty."""
    df = spark.range(200_000)
    count = lambda share: df.where(quality.drawn(share, "id", F.lit(11))).count()
    assert count(1.0) == count(7.5) == 200_000 and 800 < count(0.005) < 1200
    assert int(2000 / 10**13 * 2**63) > 10**9  # two thousand of ten trillion rows


def test_empty_table(spark):
    assert judged(spark, []) == []
