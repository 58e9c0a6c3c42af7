"""Registered queries of this package and, where SQL can express them, their
DuckDB equivalents. Each query applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import decontaminate
from .extract import extract
from .filter_audit import audit
from .hmm import score_texts
from .langid import held_out, identify
from .licenses import scan as license_scan
from .minhash import near_duplicates
from .mixing import mix_copies
from .quality import INSULTS, RULES, TOXIC_LEAST, TOXIC_ONE_IN, TOXIC_RATIO, judge, toxic_rule, toxic_words
from .runs import periodic_runs, repeat_tails
from .suffix_dedup import suffix_dedup
from .tokens import count_tokens
from .urls import judge_urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = RULES | toxic_rule(toxic_words(docs, table(spark, sf_dir, "labels")))
    return judge(docs, rules=rules).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return contaminated(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def contaminated(found: DataFrame) -> DataFrame:
    """The rule on a document's hit words: a twentieth of all, or more."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        F.col("id").alias("doc_id"),
        "text",
        "rest",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_line = F.transform("sections", lambda s: s["tokens"].cast("long").cast("string"))
    return count_tokens(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", F.size("sections").cast("long").alias("n_lines"), "n_crossing", F.array_join(per_line, ",").alias("line_tokens")
    )


def op6_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


def mixed(docs: DataFrame) -> DataFrame:
    return with_targets(*mix_copies(docs)).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def with_targets(out: DataFrame, sources: DataFrame) -> DataFrame:
    return out.join(sources.withColumnRenamed("source", "of"), out.source.eqNullSafe(F.col("of")), "left").drop("of")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", "class_size")


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op11_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = F.col("runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = periodic_runs(repeat_tails(table(spark, sf_dir, "documents"))).withColumn("longest", longest)
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality": op2_quality,
    "op3_licenses": op3_licenses,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_counts": op5_token_counts,
    "op6_extract": op6_extract,
    "op7_mixing": op7_mixing,
    "op8_minhash": op8_minhash,
    "op9_langid": op9_langid,
    "op10_url_filter": op10_url_filter,
    "op11_hmm_score": op11_hmm_score,
    "op12_filter_audit": op12_filter_audit,
    "op13_runs": op13_runs,
}

#: Words of op4 in DuckDB, and a document's or item's windows.
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLES: dict[str, str] = {
    # every 50-byte string of every text, as hexadecimal digits
    "op1_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
m AS (SELECT w.doc_id, w.i FROM w JOIN f USING (s) WHERE first < w.doc_id),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS b FROM m),
r AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE NOT near) AS spans
      FROM (SELECT doc_id, b, lag(b) OVER (PARTITION BY doc_id ORDER BY b) IS NOT DISTINCT FROM b - 1 AS near FROM g) GROUP BY doc_id),
k AS (SELECT x.doc_id, coalesce(string_agg(y, '' ORDER BY x.b) FILTER (WHERE g.b IS NULL), '') AS kept
      FROM (SELECT doc_id, b, substr(h, 2 * b + 1, 2) AS y FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS b FROM d JOIN r USING (doc_id))) x
      LEFT JOIN g USING (doc_id, b) GROUP BY x.doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "op2_quality": f"""
WITH lab AS (SELECT DISTINCT text, toxic FROM documents JOIN (SELECT doc_id, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id) USING (doc_id)
        WHERE text IS NOT NULL AND toxic IS NOT NULL),
lw AS (SELECT toxic, unnest(list_distinct({_WORDS})) AS x FROM lab),
tox AS (SELECT coalesce(list(x), CAST([] AS VARCHAR[])) AS listed FROM (SELECT x FROM lw GROUP BY x
        HAVING sum(toxic) >= greatest({TOXIC_LEAST}, ceil((SELECT count(*) FROM lab WHERE toxic = 1) / {TOXIC_ONE_IN}.0)) AND sum(toxic) >= {TOXIC_RATIO} * sum(1 - toxic))),
w AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS plain, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
                  [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines
           FROM documents),
g AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, gram FROM g GROUP BY doc_id, gram HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g JOIN twice USING (doc_id, gram)) GROUP BY doc_id),
f AS (SELECT doc_id, t, plain, words, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines OR 10 * n_repeat_words > 3 * n_words
            OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR 10 * len([x FOR x IN words IF regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]')]) < 7 * n_words
            OR 10 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 4 * word_chars
            OR 10 * (length(t) - length(regexp_replace(t, '[0-9]', '', 'g'))) > 3 * word_chars
            OR 10 * len(list_distinct(words)) < n_words OR contains(lower(t), 'lorem ipsum')
            OR len([x FOR x IN plain IF x IN ({", ".join(f"'{x}'" for x in INSULTS)})]) >= CASE WHEN n_words <= 250 THEN 1 ELSE 2 END
            OR len([x FOR x IN plain IF list_contains(listed, x)]) >= CASE WHEN n_words <= 250 THEN 1 ELSE 2 END) AS kept
FROM b, tox""",
    "op4_decontaminate": f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS m FROM items WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS win
       FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM sized)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS win
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)),
hits AS (SELECT doc_id, i, m, item_id FROM dw JOIN iw USING (m, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hits)) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)""",
    # failures as bits 1 to 16; a permutation's filters before a step as bits too
    "op12_filter_audit": """
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
f AS (SELECT doc_id, part,
        CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
        + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask FROM w),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS bad FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
x AS (SELECT unnest([0, 1, 2, 3, 4]) AS f),
p AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT array_to_string([substr('ABCDE', f + 1, 1) FOR f IN o], '') AS filter_order, step, o[step] AS f,
             coalesce(list_sum([1 << g FOR g IN o[1:step - 1]]), 0) AS before FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, s.f AS f, sum(CASE WHEN mask & (before | (1 << s.f)) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN (mask >> s.f) & 1 = 1 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN (mask >> s.f) & 1 = 1 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = (1 << s.f) THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN (mask >> s.f) & 1 = 1 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN (mask >> s.f) & 1 = 1 AND mask & before = 0 THEN bad ELSE 0 END) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, s.f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r""",
}
