"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again by the next.

1. language ID: documents without a language (no letter, or no text) go; the
   others get the predicted ``lang`` where theirs is NULL or contradicted with
   a score of CERTAIN or more;
2. MinHash near-dedup: of each group of near-duplicates the smallest id stays;
3. suffix-array dedup: text that an earlier document holds is cut out; the
   document stays, and ``n_chars`` follows;
4. decontamination: documents that the contamination rule marks go;
5. mixing: the remaining documents, with the words that each gives to the mix
   (``taken``; none where its source has more than its target), their own size
   and their source's size and target.

A NULL or empty text is dropped by the first stage; the operators define the
rest. Rows of an empty table stay none throughout. Very long texts are worked on
whole. Rows with one id and different texts are documents of their own for
stages 1, 2, 4 and 5, and one document for stage 3; of rows with equal texts,
stage 2 keeps one, so ties end there. Columns beyond those of ``documents`` are
carried along, whatever their names; the last stage's four replace columns of
those names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm.common import stored
from eventlake.llm.decontaminate import decontaminate
from eventlake.llm.langid import UNDETERMINED, identify
from eventlake.llm.minhash import keep_one
from eventlake.llm.mixing import mix_copies, with_taken
from eventlake.llm.queries import contaminated, table, with_targets
from eventlake.llm.suffix_dedup import suffix_dedup

#: Score from which a predicted language replaces a document's own.
CERTAIN = 0.9


def _as_documents(rows: DataFrame, like: DataFrame, **changed) -> DataFrame:
    """Operator output (``id``, ``text``, ``rest``) with the columns of ``like``."""
    own = {"doc_id": F.col("doc_id") if "doc_id" in rows.columns else F.col("id"), "text": F.col("text") if "text" in rows.columns else None} | changed
    return rows.select(*[(own[c] if c in own else F.col("rest")[c]).cast(like.schema[c].dataType).alias(c) for c in like.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = identify(docs).where(F.col("lang_pred") != UNDETERMINED)
    lang = F.when(F.col("score") >= CERTAIN, F.col("lang_pred")).otherwise(F.coalesce("rest.lang", "lang_pred"))
    return _as_documents(found, docs, lang=lang)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = suffix_dedup(docs, characters=True).withColumn("text", F.col("kept").cast("string"))
    return _as_documents(rows, docs, n_chars=F.length("text"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = contaminated(decontaminate(docs, table(spark, sf_dir, "benchmark")))
    return _as_documents(found.where(~F.col("contaminated")), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = with_targets(*mix_copies(docs))
    added = ["size", "source_size", "target", "taken"]
    return with_taken(docs, rows).select(*[F.col("rest")[c].alias(c) for c in docs.columns if c not in added], *added)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: No SQL for the learned, hashed and sorted stages; tests/llm holds run()
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
