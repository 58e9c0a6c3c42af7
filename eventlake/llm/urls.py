"""URL filters: rules by host and path, and gradient-boosted trees on lexical
features for the URLs that no rule decides.

The trees learn from labelled URLs. Without labels of their own, URLs are
labelled by a list of spam words: a host with one is an example to block, other
hosts (beyond those that a block rule takes for reasons of its own) are
examples to allow. The words are not a feature; the trees see shape alone:
lengths, depth, digits, entropy, parameters, and how often labelled URLs of other
hosts with the same suffix are blocked.

Only DataFrame expressions and Spark's own tree learner are used. Suffix
statistics cover all labelled URLs; the trees are fitted to at most about
TRAIN_ROWS of each label, drawn by hash.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drawn, quoted, rest_struct, stored
from .quality import once

# Rules as verdict and host with path prefix.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
# Words of spam hosts.
SPAM_WORDS = ["adult", "ads", "bet", "bets", "bonus", "casino", "cheap", "click", "credit", "dating", "escort", "farm", "gamble", "jackpot", "lottery", "loan", "loans", "payday"]
SPAM_WORDS += ["pill", "pills", "poker", "porn", "prize", "replica", "sex", "slots", "spam", "track", "tracker", "viagra", "warez", "win", "xxx"]

TRAIN_ROWS = 3000
TREES = 10
DEPTH = 3
#: Examples in a leaf at least: single hosts aren't learned by heart.
LEAF = 10
#: Weight of the overall rate in a suffix's.
PRIOR = 20.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (lower-cased), path, and the rest; empty where there is no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$"
    host, path, tail = (F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2, 3))
    return F.translate(host, UPPER, LOWER), path, tail


def fitting_rule(rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits ``host`` and ``path``: struct of rule and
    verdict, or NULL."""
    out = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        host, slash, path = rule.partition("/")
        fits = (F.col("host") == host) | F.endswith("host", F.lit("." + host))
        out = out.when(fits & F.startswith("path", F.lit(slash + path)), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
    return out


def count_of(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def entropy(text: Column) -> Column:
    """Bits per character of a short text."""
    size = F.length(text)
    chars = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    share = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    return F.when(size == 0, 0.0).otherwise(F.aggregate(chars, F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c))))


def suffix(n: int) -> Column:
    return F.substring_index("host", ".", -n)


SUFFIXES = (1, 2)
LEXICAL = {
    "f_url_length": lambda: F.length("url").cast("double"),
    "f_host_length": lambda: F.length("host").cast("double"),
    "f_path_length": lambda: F.length("path").cast("double"),
    "f_depth": lambda: count_of(F.col("path"), "/"),
    "f_labels": lambda: F.size(F.split("host", "[.]")).cast("double"),
    "f_hyphens": lambda: count_of(F.col("host"), "-"),
    "f_host_digits": lambda: count_of(F.col("host"), "[0-9]") / F.greatest(F.length("host"), F.lit(1)),
    "f_digits": lambda: count_of(F.col("url"), "[0-9]") / F.greatest(F.length("url"), F.lit(1)),
    "f_entropy": lambda: entropy(F.col("host")),
    "f_vowels": lambda: count_of(F.col("host"), "[aeiou]") / F.greatest(F.length("host"), F.lit(1)),
    "f_parameters": lambda: count_of(F.col("tail"), "="),
    "f_escapes": lambda: count_of(F.col("url"), "%"),
    "f_longest_label": lambda: F.array_max(F.transform(F.split("host", "[.]"), lambda x: F.length(x))).cast("double"),
}


def parsed(pages: DataFrame, id_col: str, url_col: str, rules: list[tuple[str, str]]) -> DataFrame:
    host, path, tail = url_parts(quoted(url_col))
    rows = pages.select(quoted(id_col).alias("id"), F.coalesce(quoted(url_col), F.lit("")).alias("url"), rest_struct(pages, id_col, url_col).alias("rest"), host.alias("host"), path.alias("path"), tail.alias("tail"))
    return once(rows, fit=fitting_rule(rules))


def spam_label() -> Column:
    """1: the host has a spam word; 0: it has none, and no block rule takes the
    URL; NULL: not labelled."""
    words = F.split("host", "[^a-z]+")
    spam = F.arrays_overlap(words, F.array(*map(F.lit, SPAM_WORDS)))
    return F.when(F.col("host") == "", F.lit(None)).when(spam, 1.0).when(F.coalesce(F.col("fit.verdict") == "block", F.lit(False)), F.lit(None)).otherwise(0.0)


def with_suffix_rates(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Adds the smoothed share of blocked URLs among the labelled ones of other
    hosts with the same last label, and the same last two labels."""
    overall = labelled.agg(F.avg("label")).first()[0] or 0.0
    rows = rows.withColumn("k_host", F.col("host")).join(totals(labelled, F.col("host"), "host"), "k_host", "left").fillna(0.0, ["s_host", "n_host"])
    for n in SUFFIXES:
        rows = rows.withColumn(f"k_{n}", suffix(n)).join(totals(labelled, suffix(n), str(n)), f"k_{n}", "left").fillna(0.0, [f"s_{n}", f"n_{n}"])
        rate = (F.col(f"s_{n}") - F.col("s_host") + PRIOR * overall) / (F.col(f"n_{n}") - F.col("n_host") + PRIOR)
        rows = rows.withColumn(f"f_rate_{n}", rate).drop(f"k_{n}", f"s_{n}", f"n_{n}")
    return rows.drop("k_host", "s_host", "n_host")


def totals(labelled: DataFrame, key: Column, name: str) -> DataFrame:
    return labelled.groupBy(key.alias(f"k_{name}")).agg(F.sum("label").alias(f"s_{name}"), F.count("*").cast("double").alias(f"n_{name}"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str]] = RULES, label: Column | None = None) -> DataFrame:
    """A verdict on every URL.

    Returns ``id``, ``host``, ``path``, ``rule`` (the longest that fits; NULL
    without one), ``verdict`` (``allow`` or ``block``: the rule's, else the
    trees') and ``rest`` (a struct of the other columns), a row for each input
    row. ``label`` (1.0 block, 0.0 allow, NULL unknown; over ``host``, ``path``,
    ``url``, ``fit``) replaces the labelling by spam words.

    A URL that is NULL or has no ``://`` has an empty host and path, no rule,
    and is allowed. If the labelled URLs have one label only, that is the
    verdict; with none, ``allow``. Equal URLs get equal verdicts.
    """
    names = ["id", "host", "path", "rule", "verdict", "rest"]
    rows = parsed(pages, id_col, url_col, rules)
    label = spam_label() if label is None else label
    labelled = stored(rows.select("url", "host", "path", "tail", "fit", F.xxhash64("url").alias("draw"), label.alias("label")).where("label is not null"), "urls")
    sizes = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    decided = F.col("fit.verdict")
    if len(sizes) < 2:
        only = "block" if 1.0 in sizes else "allow"
        model_verdict = F.when(F.col("host") == "", "allow").otherwise(only)
        return rows.select("id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(decided, model_verdict).alias("verdict"), "rest")
    picked = labelled.where(F.when(F.col("label") == 1.0, drawn(TRAIN_ROWS / sizes[1.0], "draw")).otherwise(drawn(TRAIN_ROWS / sizes[0.0], "draw")))
    lexical = lambda df: df.select("*", *[f().alias(n) for n, f in LEXICAL.items()])
    features = [*LEXICAL, *[f"f_rate_{n}" for n in SUFFIXES]]
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    # one partition in a fixed order: the same trees each time
    sample = stored(with_suffix_rates(lexical(picked), labelled).select("label", *features).repartition(1).sortWithinPartitions("label", *features), "urls-sample")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, minInstancesPerNode=LEAF, seed=1, stepSize=0.3).fit(assembler.transform(sample.coalesce(1)))
    scored = model.transform(assembler.transform(with_suffix_rates(lexical(rows), labelled)))
    learned = F.when((F.col("prediction") == 1.0) & (F.col("host") != ""), "block").otherwise("allow")
    return scored.withColumn("rule", F.col("fit.rule")).withColumn("verdict", F.coalesce(decided, learned)).select(*names)
