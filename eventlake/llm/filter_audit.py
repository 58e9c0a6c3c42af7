"""How filters interact: what each removes in every order they can be applied.

A document's failures are the bits of a mask, so the counts of documents by
mask answer every order: a filter at some step removes the masks that have its
bit and none of the filters before it. Masks add up by part, map-side first.

The duplicates filter needs the smallest id of each text, table-wide. A
counting Bloom filter spares most texts the shuffle: each task counts its
texts' hashes in a sketch (counters end at 2), the sketches are merged, and a
text with a counter under 2 is the only one of its kind. Only the others, the
possible repeats, are grouped by their full text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix64, pack, quoted, stored, unpack
from .quality import once, word_list

#: When a document fails, by its ``text``, list of ``words`` and ``n_words``.
FILTERS: dict[str, Callable[[], Column]] = {
    "A": lambda: F.col("n_words") < 200,
    "B": lambda: 100 * F.size(F.array_distinct("words")) < 50 * F.col("n_words"),
    "C": lambda: 100 * F.regexp_count("text", F.lit("[A-Z]")) > 2 * F.length("text"),
    "D": lambda: F.col("text").rlike(r"[#$%&*|]"),
}
#: The filter of texts that a smaller id has as well; the mask's last bit.
DUPLICATES = "E"

#: Counters of the sketch for each document, and the bounds of all of them.
#: One bit of each is broadcast: 32 MB at most. Beyond some 30 million
#: documents the sketch clears ever fewer texts; results stay the same.
PER_TEXT = 16
FEWEST, MOST = 1 << 16, 1 << 28
PROBES = 3
#: Counters of one segment, the unit in which sketches are merged.
SEGMENT = 1 << 16
#: Tasks' sketches are merged in two steps, the first in so many parts.
SALTS = 16
#: Hashes a task gathers before it sends their sketch.
GATHERED = 1 << 20

_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def probes(h: np.ndarray, counters: int) -> np.ndarray:
    """The counters of each 64-bit hash, a row for each probe."""
    h = h.astype(np.int64).view(np.uint64)
    step = mix64(h ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
    return np.stack([mix64(h + np.uint64(k) * step) & np.uint64(counters - 1) for k in range(PROBES)]).astype(np.int64)


def sketch(counters: int):
    """A task's sketch, by segment: places and counts (to 2) of its hashes."""

    def emit(hashes: list[np.ndarray]):
        # a text that holds a counter with two of its probes counts once there
        at = np.sort(probes(np.concatenate(hashes), counters), axis=0)
        once_ = np.ones(at.shape, dtype=bool)
        once_[1:] = at[1:] != at[:-1]
        place, count = np.unique(at[once_], return_counts=True)
        count = np.minimum(count, 2).astype(np.uint8)
        segment = place // SEGMENT
        cuts = np.flatnonzero(np.diff(segment, prepend=-1))
        rows = [pack((p % SEGMENT).astype("<u2"), c) for p, c in zip(np.split(place, cuts[1:]), np.split(count, cuts[1:]), strict=True)]
        salt = int(place[0]) % SALTS
        return pa.RecordBatch.from_arrays([pa.array(segment[cuts]), pa.array([salt] * len(cuts), pa.int64()), pa.array(rows, pa.binary())], names=["segment", "salt", "counts"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch["h"].to_numpy(zero_copy_only=False))
            size += batch.num_rows
            if size >= GATHERED:
                yield emit(held)
                held, size = [], 0
        if size:
            yield emit(held)

    return run


def merged(counts: list[bytes]) -> np.ndarray:
    """The sum of one segment's sketches, to 2."""
    total = np.zeros(SEGMENT, dtype=np.uint8)
    for value in counts:
        place, count = unpack(value)
        total[place] = np.minimum(total[place] + count, 2)
    return total


def merge(group: pa.Table) -> pa.Table:
    total = merged(group["counts"].to_pylist())
    place = np.flatnonzero(total)
    return pa.table({"segment": group["segment"][:1], "counts": pa.array([pack(place.astype("<u2"), total[place])], pa.binary())})


def merge_last(group: pa.Table) -> pa.Table:
    return pa.table({"segment": group["segment"][:1], "twice": pa.array([np.packbits(merged(group["counts"].to_pylist()) == 2).tobytes()], pa.binary())})


def repeats_test(hashes: DataFrame, rows: int) -> Callable[[Column], Column]:
    """A test that a text's hash can be another row's too, by the merged
    sketch of all ``rows`` hashes (column ``h``); never false for a repeat."""
    spark = hashes.sparkSession
    counters = FEWEST
    while counters < MOST and counters < PER_TEXT * rows:
        counters *= 2
    found = (
        hashes.select("h")
        .mapInArrow(sketch(counters), "segment long, salt long, counts binary")
        .groupBy("segment", "salt")
        .applyInArrow(merge, "segment long, counts binary")
        .groupBy("segment")
        .applyInArrow(merge_last, "segment long, twice binary")
    )
    bits = np.zeros(counters // 8, dtype=np.uint8)
    for r in found.toLocalIterator():
        bits[r.segment * SEGMENT // 8 : (r.segment + 1) * SEGMENT // 8] = np.frombuffer(r.twice, np.uint8)
    twice = spark.sparkContext.broadcast(bits)

    @F.arrow_udf(T.BooleanType())
    def test(h: pa.Array) -> pa.Array:
        at = probes(h.to_numpy(zero_copy_only=False), counters)
        return pa.array(((twice.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0))

    return test


def rows_of_part(letters: str):
    """The counts of every order and step, from a part's counts by mask."""
    masks = np.arange(1 << len(letters))
    orders = list(permutations(range(len(letters))))
    failing = {f: (masks >> f & 1).astype(bool) for f in range(len(letters))}
    step_rows, name, step, removes, fails, alone, remains = [], [], [], [], [], [], []
    for order in orders:
        gone = np.zeros(len(masks), dtype=bool)
        for k, f in enumerate(order):
            step_rows.append(f)
            name.append("".join(letters[x] for x in order))
            step.append(k + 1)
            removes.append(failing[f] & ~gone)
            fails.append(failing[f] & gone)
            alone.append(masks == 1 << f)
            gone = gone | failing[f]
            remains.append(~gone)
    matrices = {"kept": remains, "removed": removes, "redundant": fails, "unique_fails": alone}
    matrices = {k: np.array(v).astype(np.int64) for k, v in matrices.items()}
    owner = np.array(step_rows)

    def run(batches):
        for batch in batches:
            parts, found = batch["part"].to_pylist(), batch["masks"].to_pylist()
            for part, rows in zip(parts, found, strict=True):
                n, good, toxic = (np.zeros(len(masks), dtype=np.int64) for _ in range(3))
                for r in rows:
                    n[r["mask"]], good[r["mask"]], toxic[r["mask"]] = r["n"], r["good"], r["toxic"]
                out = {k: m @ n for k, m in matrices.items()}
                out |= {"good_lost": matrices["removed"] @ good, "toxic_lost": matrices["removed"] @ toxic}
                by_filter = np.zeros(len(letters), dtype=np.int64)
                np.add.at(by_filter, owner, out["removed"])
                out["shapley"] = by_filter[owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(name), pa.string()), pa.array(name), pa.array(step, pa.int32()), *(pa.array(out[c]) for c in _COUNTS)],
                    names=["part", "filter_order", "step", *_COUNTS],
                )

    return run


def failures(docs: DataFrame, id_col: str, text_col: str, part_col: str, filters: Mapping[str, Callable[[], Column]]) -> DataFrame:
    """``id``, ``part``, ``mask`` of the text's failures and hash ``h``, a row
    for each input row."""
    rows = docs.select(quoted(id_col).alias("id"), F.coalesce(quoted(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    rows = once(rows, words=word_list(F.col("text")))
    rows = once(rows, n_words=F.size("words"))
    mask = sum((F.when(fails(), 1 << k).otherwise(0) for k, fails in enumerate(filters.values())), F.lit(0))
    return rows.select("id", "part", mask.cast("int").alias("mask"), F.xxhash64("text").alias("h"))


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    filters: Mapping[str, Callable[[], Column]] = FILTERS,
) -> DataFrame:
    """What each filter removes at each step of each order, by part.

    ``filters`` (one-letter names, by the text) and ``DUPLICATES``, which a
    text fails that a smaller id has too. ``labels``: ``doc_id``, ``quality``
    and ``toxic``; of several rows of an id, one with 1 is enough. Returns, for
    each value of ``part_col``, order and step: ``part``, ``filter_order``,
    ``step``, and counts of the part's rows: ``kept`` after the step,
    ``removed`` by it, ``redundant`` (failing its filter, removed before),
    ``unique_fails`` (failing only its filter), ``good_lost`` and
    ``toxic_lost`` (removed, labelled 1), and ``shapley`` (what its filter
    removes, summed over all orders).

    A NULL text counts as empty and equals other empty ones; a NULL part is the
    empty string's. Rows are counted one by one, repeated ones too; those of an
    equal id aren't each other's duplicates, and a row with a NULL id has none
    and is none's. Very long texts are taken whole. No other column is read, so
    names can't clash. An empty table gives an empty result.
    """
    if any(len(x) != 1 for x in filters) or DUPLICATES in filters or not 1 <= len(filters) <= 6:
        raise ValueError("one to six filters, with one-letter names of their own")
    spark: SparkSession = docs.sparkSession
    flags = stored(failures(docs, id_col, text_col, part_col, filters), "audit")
    possible = repeats_test(flags, flags.count())
    text = F.coalesce(quoted(text_col), F.lit(""))
    # the smallest id of each possible repeat's text, known by its hash again
    firsts = (
        docs.select(quoted(id_col).alias("id"), text.alias("text"))
        .where(possible(F.xxhash64("text")))
        .groupBy("text")
        .agg(F.min("id").alias("id"))
        .select("id", F.xxhash64("text").alias("h"), F.lit(True).alias("first"))
    )
    marked = flags.withColumn("possible", possible("h")).join(firsts, ["id", "h"], "left")
    by_id = labels.groupBy(quoted("doc_id").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    again = F.col("possible") & F.col("id").isNotNull() & F.col("first").isNull()
    counted = (
        marked.join(by_id, "id", "left")
        .groupBy("part", (F.col("mask") + F.when(again, 1 << len(filters)).otherwise(0)).alias("mask"))
        .agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    )
    # at most one row for each mask
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    schema = T.StructType.fromDDL("part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS))
    return parts.mapInArrow(rows_of_part("".join([*filters, DUPLICATES])), schema)
