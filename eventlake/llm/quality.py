"""Quality rules as a short-circuit cascade.

Each rule says when a document is rejected. A sample is run through every rule
on its own: the share it rejects and the time it takes. The cascade asks the
rules in the order of rejections per second, and a document meets the next rule
only if none before rejected it. The order changes the cost, never the verdict.

Insults of English are a list; toxic words of any language are learned from
labelled documents, all of them: words that many toxic texts hold, and hardly a
clean one.

Only DataFrame expressions are used. Word lists are made once for each row,
behind a generator, so that rules which look at them several times don't build
them again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import DEFAULT_MAX_BROADCAST_BYTES, fits, join_small, likely_in
from .common import drawn, quoted, rest_struct, stored

#: Rows that the order of the rules is estimated on, about.
SAMPLE_ROWS = 2000
#: Up to so many repeated word windows are looked up one by one.
FEW = 8

# Common insults, as a word list.
INSULTS = ["clown", "disgusting", "dumb", "filth", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless"]
#: Learned toxic words: in so many toxic texts, in one of so many toxic texts,
#: and in so many times more toxic texts than clean ones.
TOXIC_LEAST, TOXIC_ONE_IN, TOXIC_RATIO = 3, 200, 20
#: Words of letters and digits, A-Z lower-cased.
PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTER = "[A-Za-z]|[^\\x00-\\x7F]"


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns, each computed once for a row however often
    later expressions use it."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def word_list(text: Column) -> Column:
    for space in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.filter(F.split(text, " "), lambda w: w != "")


def repeat_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words in three-word windows that the text holds
    twice or more. Windows are compared by 64-bit hash within their document."""
    df = once(
        df,
        grams=F.when(
            F.size("words") >= 3, F.transform(F.slice("words", F.lit(1), F.size("words") - 2), lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
        ).otherwise(F.expr("cast(array() as array<long>)")),
    )
    df = once(df, in_order=F.sort_array("grams"))
    df = once(df, twice=F.array_distinct(F.filter("in_order", lambda g, i: g == F.get("in_order", i - 1))))
    few = F.filter(F.transform("grams", lambda g, i: F.when(F.array_contains("twice", g), i)), lambda i: i.isNotNull())
    pairs = F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    df = once(df, by_gram=F.when(F.size("twice") > FEW, pairs))
    same = lambda p, k: p["g"] == F.get("by_gram", k)["g"]
    many = F.sort_array(F.transform(F.filter("by_gram", lambda p, k: F.coalesce(same(p, k - 1), F.lit(False)) | F.coalesce(same(p, k + 1), F.lit(False))), lambda p: p["i"]))
    df = once(df, places=F.when(F.size("twice") == 0, F.expr("cast(array() as array<int>)")).when(F.size("twice") <= FEW, few).otherwise(many))
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
    )["n"]
    return once(df, n_repeat_words=covered).drop("grams", "in_order", "twice", "by_gram", "places")


def with_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``text`` (NULL as empty), ``rest``, the list ``words``, and counts:
    ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (with a word),
    ``n_dup_lines``, ``n_repeat_words``."""
    rows = docs.select(quoted(id_col).alias("id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"), rest_struct(docs, id_col, text_col).alias("rest"))
    rows = once(rows, words=word_list(F.col("text")), lines=F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = once(
        rows,
        n_words=F.size("words").cast("long"),
        word_chars=F.length(F.array_join("words", "")).cast("long"),
        n_symbols=F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long"),
        n_lines=F.size("lines").cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
    )
    return repeat_words(rows.drop("lines"))


def removed(pattern: str) -> Column:
    """Characters of the text that match a one-character pattern."""
    return F.length("text") - F.length(F.regexp_replace("text", pattern, ""))


def told(words: list[str]) -> Column:
    """Does the text hold two of the words, or one in up to 250 words."""
    return F.size(F.filter("plain", lambda w: w.isin(words))) >= F.when(F.col("n_words") <= 250, 1).otherwise(2)


#: When a document is rejected, beyond the base rule.
RULES: dict[str, Callable[[], Column]] = {
    "symbols": lambda: F.expr("10 * n_symbols > 3 * n_words"),
    "repeated_lines": lambda: F.expr("2 * n_dup_lines > n_lines"),
    "repeated_words": lambda: F.expr("10 * n_repeat_words > 3 * n_words"),
    "word_length": lambda: F.expr("word_chars < 2 * n_words or word_chars > 12 * n_words"),
    "few_words_with_letters": lambda: 10 * F.size(F.filter("words", lambda w: w.rlike(LETTER))) < 7 * F.col("n_words"),
    "capitals": lambda: 10 * removed("[A-Z]") > 4 * F.col("word_chars"),
    "digits": lambda: 10 * removed("[0-9]") > 3 * F.col("word_chars"),
    "few_different_words": lambda: 10 * F.size(F.array_distinct("words")) < F.col("n_words"),
    "placeholder": lambda: F.lower("text").contains("lorem ipsum"),
    "insults": lambda: told(INSULTS),
}


def plain_words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _UPPER.lower()), F.lit(PLAIN), F.lit(0))


def toxic_words(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """Words that tell toxic texts, learned from all labelled documents.

    ``labels``: ``doc_id`` and ``toxic``; of several rows of an id, one with 1
    is enough, and an id without a label teaches nothing. Equal texts count
    once. A word is listed if TOXIC_LEAST toxic texts hold it, one in
    TOXIC_ONE_IN of them, and TOXIC_RATIO times as many toxic as clean texts.
    There are at most TOXIC_ONE_IN times as many candidates as a toxic text has
    different words on average, so they are broadcast, and only they are
    counted in clean texts. Labels are broadcast up to a checked size; more are
    joined by a shuffle of the texts that are likely to have one, unsalted: ids
    and row numbers hardly repeat. No labels, no words.
    """
    by_id = labels.groupBy(quoted("doc_id").alias("id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).where(F.col("toxic").isNotNull())
    texts, marks = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).where(F.col("text").isNotNull()), stored(by_id, "labels")
    small = fits(marks, DEFAULT_MAX_BROADCAST_BYTES)
    texts = join_small(texts if small else likely_in(texts, marks, "id"), marks, ["id"], "inner", small_fits=small, salt_buckets=1)
    texts = stored(
        texts.select("toxic", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"), F.array_distinct(plain_words(F.col("text"))).alias("words")), "labelled"
    )
    # copies of a text have its words: one of them does
    firsts = stored(texts.groupBy("toxic", "h").agg(F.min("row").alias("row")).select("row"), "labelled-once")
    texts = join_small(texts, firsts, ["row"], "left_semi", salt_buckets=1)
    toxic = texts.where(F.col("toxic") == 1)
    least = max(TOXIC_LEAST, -(-toxic.count() // TOXIC_ONE_IN))
    often = toxic.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("toxic")).where(F.col("toxic") >= least)
    often = stored(often, "toxic-words")
    clean = texts.where(F.col("toxic") == 0).select(F.explode("words").alias("word")).join(F.broadcast(often.select("word")), "word").groupBy("word").agg(F.count("*").alias("clean"))
    rows = often.join(clean, "word", "left").where(F.col("toxic") >= TOXIC_RATIO * F.coalesce("clean", F.lit(0)))
    return sorted(r.word for r in rows.select("word").collect())


def toxic_rule(words: list[str]) -> dict[str, Callable[[], Column]]:
    """The rule that rejects by learned words: two, or one in up to 250 words."""
    return {"toxic_words": lambda: told(words)}


def base_failed() -> Column:
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def with_plain(rows: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and, for rows that pass, the list ``plain`` of words
    of letters."""
    return once(once(rows, base_failed=base_failed()), plain=F.when(~F.col("base_failed"), plain_words(F.col("text"))))


def rule_order(docs: DataFrame, id_col: str, text_col: str, rules: Mapping[str, Callable[[], Column]], sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules by rejections per second on a sample of the documents.

    Rows are drawn by hash of the id. An empty sample leaves the given order."""
    total = docs.count()
    if not total:
        return list(rules)
    sample = stored(with_plain(with_features(docs.where(drawn(sample_rows / total, quoted(id_col), F.lit(11))), id_col, text_col)).drop("rest"), "quality-sample")

    def timed(reject: Column) -> tuple[float, int]:
        start = time.perf_counter()
        n = sample.agg(F.count_if(reject)).first()[0]
        return time.perf_counter() - start, n

    timed(F.lit(False))  # reading alone, the first time with what compiling takes
    base, _ = timed(F.lit(False))
    worth = {}
    for name, rule in rules.items():
        seconds, rejected = timed(rule())
        worth[name] = rejected / max(seconds - base, 1e-3)
    return sorted(rules, key=lambda r: -worth[r])


def cascade(order: list[str], rules: Mapping[str, Callable[[], Column]]) -> Column:
    """The first rule, in this order, that rejects the row; NULL if none does.
    Later rules are not evaluated."""
    chain = F.when(F.lit(False), F.lit(""))
    for name in order:
        chain = chain.when(rules[name](), F.lit(name))
    return chain


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Mapping[str, Callable[[], Column]] = RULES) -> DataFrame:
    """Each document's counts and verdict: ``with_features`` without the word
    lists, ``base_failed``, ``rejected_by`` (the rule that rejected it first;
    NULL if kept, or if it failed the base) and ``kept``.

    NULL and empty texts have no words and fail the base; very long texts are
    judged whole. Equal rows get equal verdicts; ``rejected_by`` depends on the measured order where several rules
    reject. An empty table gives an empty result.
    """
    order = rule_order(docs, id_col, text_col, rules)
    rows = with_plain(with_features(docs, id_col, text_col))
    rows = once(rows, rejected_by=F.when(F.col("base_failed"), F.lit(None)).otherwise(cascade(order, rules)))
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull()).drop("words", "plain")
