"""Mixing sources to target weights by min-cost flow.

Documents are grouped by membership pattern (the set of sources they belong
to). Words flow from patterns to the sources' quotas; a pattern's first copy
costs nothing, the next one more each, so documents repeat only where quotas
need it. The flow's graph has a node for each pattern and each source, solved
on the driver; everything by document stays in tables.

A pattern's flow is then laid along its documents in seeded order, the whole
pattern once, then again from the start: each document takes the words of its
stretches that lie inside the flow, and the sources divide the flow between
them end to end. So each pattern takes exactly what the flow gives it.

Places in that order come from sums by hash bucket, then inside each bucket,
so that no task orders a whole source.

``mix`` takes rows that name several sources. ``mix_copies`` finds the overlap
itself: a text belongs to every source in which an equal text occurs, and its
words count once, whichever source takes them.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import quoted, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
#: Hash buckets of a pattern's documents.
BUCKETS = 4096
#: A text and source with more than one in this many rows is split by salt.
HOT = 1000
SALTS = 64


def source_order(name: str | None):
    """Sources by code point, NULL last."""
    return (name is None, name or "")


def targets(sizes: dict, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> dict:
    """Each source's words: ``share`` of all sizes by weight (repeating over
    the ordered sources); what is above ``repeats`` times a source's size is
    shared anew among the others, until none is above."""
    names = sorted(sizes, key=source_order)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        each = left / sum(weight[s] for s in free)
        above = {s for s in free if each * weight[s] > repeats * sizes[s]}
        if not above:
            return out | {s: each * weight[s] for s in free}
        out |= {s: float(repeats * sizes[s]) for s in above}
        left -= sum(out[s] for s in above)
        free -= above
    return out


def components(patterns: list[tuple]) -> list[list[int]]:
    """Numbers of patterns that are linked by common sources."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, members in enumerate(patterns):
        for s in members:
            parent[root(("p", i))] = root(("s", s))
    groups = defaultdict(list)
    for i in range(len(patterns)):
        groups[root(("p", i))].append(i)
    return list(groups.values())


def min_cost_flow(patterns: list[tuple], sizes: list[int], quotas: dict, repeats: int = REPEATS) -> list[dict]:
    """Words from each pattern to each of its sources.

    As much flow as the quotas and ``repeats`` copies of each pattern allow,
    at the least cost, where copy number r of a word costs r - 1; by shortest
    augmenting paths."""
    flow: list[dict] = [dict.fromkeys(p, 0) for p in patterns]
    used = [0] * len(patterns)
    left = dict(quotas)
    for group in components(patterns):
        by_source = defaultdict(list)
        for i in group:
            for s in patterns[i]:
                by_source[s].append(i)
        if len(by_source) == 1 and len(group) == 1:
            i, (s,) = group[0], patterns[group[0]]
            used[i] = flow[i][s] = min(repeats * sizes[i], left[s])
            continue
        for copy in range(1, repeats + 1):  # all paths of one cost, then of the next
            grown = True
            while grown:
                grown = False
                # breadth first from the patterns that have words at this cost
                came: dict = {("p", i): None for i in group if used[i] < copy * sizes[i]}
                queue, goal = list(came), None
                for node in queue:
                    kind, x = node
                    if kind == "s" and left[x] > 0:
                        goal = node
                        break
                    nxt = [("s", s) for s in patterns[x]] if kind == "p" else [("p", i) for i in by_source[x] if flow[i][x] > 0]
                    for n in nxt:
                        if n not in came:
                            came[n] = node
                            queue.append(n)
                if goal is None:
                    break
                path = [goal]
                while came[path[-1]] is not None:
                    path.append(came[path[-1]])
                path.reverse()
                first = path[0][1]
                room = min(copy * sizes[first] - used[first], left[goal[1]])
                for a, b in zip(path, path[1:], strict=False):
                    if a[0] == "s":
                        room = min(room, flow[b[1]][a[1]])
                for a, b in zip(path, path[1:], strict=False):
                    if a[0] == "p":
                        flow[a[1]][b[1]] += room
                    else:
                        flow[b[1]][a[1]] -= room
                used[first] += room
                left[goal[1]] -= room
                grown = True
    return flow


def route(patterns: list[tuple], sizes: list[int], limits: list[dict], quotas: dict) -> list[dict]:
    """Words from each pattern to each of its sources, at most ``limits``.

    Fills the quotas as far as the limits allow, at the least cost: a pattern's
    words cost nothing the first time, one the second and two from then on. All
    paths of one cost, then of the next: first straight from patterns to
    sources, then through other sources that give words of theirs back."""
    out: list[dict] = [dict.fromkeys(p, 0) for p in patterns]
    for group in components(patterns):
        names = sorted({s for i in group for s in patterns[i]}, key=source_order)
        at = {s: j for j, s in enumerate(names)}
        cap = np.zeros((len(group), len(names)), dtype=np.int64)
        for k, i in enumerate(group):
            for s in patterns[i]:
                cap[k, at[s]] = limits[i][s]
        whole = np.array([sizes[i] for i in group], dtype=np.int64)
        left = np.array([quotas[s] for s in names], dtype=np.int64)
        flow, used = np.zeros_like(cap), np.zeros_like(whole)
        for bound in (whole, 2 * whole, cap.sum(axis=1)):
            for j in range(len(names)):
                free = np.minimum(np.maximum(bound - used, 0), cap[:, j] - flow[:, j])
                take = np.clip(left[j] - (np.cumsum(free) - free), 0, free)
                flow[:, j] += take
                used += take
                left[j] -= take.sum()
            while (left > 0).any():
                free = np.minimum(np.maximum(bound - used, 0)[:, None], cap - flow)
                best = free.argmax(axis=0)
                came = {j: (int(best[j]), None) for j in range(len(names)) if free[best[j], j] > 0}
                queue, goal = list(came), None
                for j in queue:
                    if left[j] > 0:
                        goal = j
                        break
                    moved = np.minimum(flow[:, [j]], cap - flow)
                    best = moved.argmax(axis=0)
                    for t in range(len(names)):
                        if t not in came and moved[best[t], t] > 0:
                            came[t] = (int(best[t]), j)
                            queue.append(t)
                if goal is None:
                    break
                path, t = [], goal
                while t is not None:
                    path.append((*came[t], t))
                    t = came[t][1]
                first, _, head = path[-1]
                words = min(left[goal], free[first, head], *(min(flow[k, j], cap[k, t] - flow[k, t]) for k, j, t in path[:-1]))
                for k, j, t in path:
                    flow[k, t] += words
                    if j is not None:
                        flow[k, j] -= words
                used[first] += words
                left[goal] -= words
        for k, i in enumerate(group):
            out[i] = {s: int(flow[k, at[s]]) for s in patterns[i]}
    return out


def mix_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """How many words of each row the mix takes, where equal texts in several
    sources are the sources' overlap.

    A text's pattern is the set of sources that hold it. ``route`` shares each
    pattern's words between its sources; a source takes them from its own rows
    only, at most ``repeats`` times each. Sources of a pattern begin where the
    one before ended, with one row of each text, and come to further copies
    last, so no word is taken twice before all of its pattern are taken.

    Returns two tables: rows (``id``, ``key``: the text's digest, ``source``,
    ``members``, ``size`` in words, ``taken``), one for each input row; and
    sources (``source``, ``source_size``, ``target``, ``routed``).

    A NULL or empty text, or one without words, has size 0, no members, and
    gives nothing; very long texts count whole. A NULL source is a source of its
    own, last in order. Repeated rows are copies; which of two rows with equal
    id, text and source gives the words is open. Reruns agree. An empty table
    gives two empty ones. The driver holds a row for each pattern and source.
    """
    spark = docs.sparkSession
    text = quoted(text_col)
    rows = stored(
        docs.select(
            quoted(id_col).alias("id"),
            quoted(source_col).cast("string").alias("source"),
            text_key(text).alias("key"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(quoted(id_col), text, F.lit(seed)).alias("draw"),
            F.monotonically_increasing_id().alias("nr"),
        ).withColumn("own", F.to_json(F.array("source"))),
        "mix",
    )
    held = rows.where("size > 0").groupBy("key", "own").agg(
        F.max("source").alias("source"), F.max("size").alias("size"), F.count("*").alias("n"), F.min(F.struct("draw", "id", "nr"))["nr"].alias("first")
    )
    texts = stored(
        held.groupBy("key")
        .agg(F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("own", "source", "n", "first"))).alias("held"))
        .select("key", "size", "held", F.to_json(F.col("held.source")).alias("pattern"), F.xxhash64("key", F.lit(seed)).alias("draw"))
        .withColumn("bucket", F.pmod("draw", F.lit(BUCKETS))),
        "mix-texts",
    )

    # words by pattern and source: each text once, and all its copies
    found = texts.select("pattern", "size", F.explode("held").alias("h")).groupBy("pattern", "h.source").agg(F.sum("size").alias("whole"), F.sum(F.col("size") * F.col("h.n")).alias("held")).collect()
    by_pattern: dict = defaultdict(dict)
    whole: dict = {}
    total: dict = {r.source: 0 for r in rows.select("source").distinct().collect()}
    for r in found:
        by_pattern[r.pattern][r.source] = r.held
        whole[r.pattern] = r.whole
        total[r.source] += r.held
    target = targets(total, weights, share, repeats)
    names = sorted(by_pattern)
    flow = route(
        [tuple(sorted(by_pattern[p], key=source_order)) for p in names],
        [whole[p] for p in names],
        [{s: repeats * n for s, n in by_pattern[p].items()} for p in names],
        {s: round(t) for s, t in target.items()},
    )
    laid, routed = [], defaultdict(int)
    for p, f in zip(names, flow, strict=True):
        at = 0
        for s in sorted(f, key=source_order):
            laid.append((p, s, whole[p], by_pattern[p][s], at % whole[p], f[s]))
            at += f[s]
            routed[s] += f[s]
    quota = spark.createDataFrame(laid, "pattern string, source string, whole long, held long, at long, words long").withColumn("own", F.to_json(F.array("source"))).drop("source")
    sources = spark.createDataFrame([(s, total[s], target[s], routed[s]) for s in sorted(total, key=source_order)], "source string, source_size long, target double, routed long")

    # each text's place among its pattern's
    placed = with_place(texts, ["pattern"], F.col("size"), ["draw", "key"], "place")
    one = placed.select("key", "pattern", "place", F.col("held.source").alias("members"), F.explode("held").alias("h")).select("key", "h.own", "pattern", "place", "members", "h.first", "h.n")

    # rows to their texts; a text with very many rows in a source is salted
    limit = rows.count() // HOT
    hot = one.where(F.col("n") > limit).select("key", "own", F.lit(SALTS).alias("salts"))  # under HOT rows
    salts = F.coalesce("salts", F.lit(1))
    copies = rows.join(F.broadcast(hot), ["key", "own"], "left").withColumn("salt", F.pmod(F.xxhash64("nr"), salts).cast("int")).drop("salts")
    one = one.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(F.col("n") > limit, F.lit(SALTS)).otherwise(1) - 1))).drop("n")
    joined = stored(copies.join(one, ["key", "own", "salt"], "left").withColumn("later", F.col("nr") != F.col("first")), "mix-rows")

    # each further copy's place among its source's, then the words of each pass
    again = with_place(joined.where("later").withColumn("bucket", F.pmod("draw", F.lit(BUCKETS))), ["pattern", "own"], F.col("size"), ["draw", "id", "nr"], "copy_place").drop("bucket")
    every = joined.where(~F.coalesce("later", F.lit(False))).withColumn("copy_place", F.lit(None).cast("long")).unionByName(again).join(quota, ["pattern", "own"], "left")
    zero = F.lit(0).cast("long")
    overlap = lambda a, n, lo, hi: F.greatest(zero, F.least(a + n, hi) - F.greatest(a, lo))
    taken = zero
    for c in range(repeats):
        rest = F.col("words") - c * F.col("held")
        once = F.greatest(zero, F.least(rest, F.col("whole")))
        more = F.greatest(zero, F.least(rest, F.col("held")) - F.col("whole"))
        turns = [overlap(F.col("place") + k * F.col("whole"), F.col("size"), F.col("at"), F.col("at") + once) for k in range(2)]
        taken = taken + F.when(F.col("later"), overlap(F.col("copy_place"), F.col("size"), zero, more)).otherwise(turns[0] + turns[1])
    none = F.expr("cast(array() as array<string>)")
    return every.select("id", "key", "source", F.coalesce("members", none).alias("members"), "size", F.when(F.col("words").isNull(), zero).otherwise(taken).alias("taken")), sources


def with_taken(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` as ``rest``, with the columns that ``mixed`` (made by
    ``mix_copies`` of the same rows) has beside ``id`` and ``key``. Rows with
    equal id, text and source are paired in any order."""
    same = Window.partitionBy("id", "key", "from")
    left = docs.select(
        quoted(id_col).alias("id"),
        text_key(quoted(text_col)).alias("key"),
        F.to_json(F.array(quoted(source_col).cast("string"))).alias("from"),
        F.struct(*[quoted(c) for c in docs.columns]).alias("rest"),
    ).withColumn("nth", F.row_number().over(same.orderBy(F.lit(0))))
    right = mixed.withColumn("from", F.to_json(F.array("source"))).withColumn("nth", F.row_number().over(same.orderBy("taken")))
    on = [left[c].eqNullSafe(right[c]) for c in ("id", "key", "from", "nth")]
    return left.join(right, on).select(left["rest"], *[right[c] for c in mixed.columns if c not in ("id", "key")])


def text_key(text: Column) -> Column:
    """A text's digest; NULL counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def with_place(rows: DataFrame, group: list[str], size: Column, order: list[str], name: str) -> DataFrame:
    """``rows`` (with a ``bucket``) and the sum of ``size`` over the rows of the
    group before each: of earlier buckets, then inside its own."""
    inside = Window.partitionBy(*group, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*group, "bucket").agg(F.sum(size).alias("part")).select(*group, "bucket", F.coalesce(F.sum("part").over(above), F.lit(0)).alias("base"))
    return rows.join(sums, [*group, "bucket"]).withColumn(name, F.col("base") + F.coalesce(F.sum(size).over(inside), F.lit(0))).drop("base")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    members: Column | None = None,
    weights=WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """How many words of each document the mix takes.

    ``members``: array of the sources a row belongs to (default: its
    ``source``); a source's size counts all its rows. Returns two tables:
    documents (``id``, ``members``, ``size`` in words, ``taken``, and
    ``taken_by``: array of source and words), a row for each input row; and
    sources (``source``, ``source_size``, ``target``, and ``routed``: the words
    of the flow).

    NULL text has size 0, and size 0 takes nothing. A NULL source is a source
    of its own, last in order; a row without members takes nothing. Rows with
    equal id and text share a place in the seeded order, so which of them comes
    first is open, but not how many words they take together. Reruns agree. The
    driver holds a row for each pattern and source.
    """
    spark = docs.sparkSession
    members = F.array(quoted("source").cast("string")) if members is None else members
    rows = stored(
        docs.select(
            quoted(id_col).alias("id"),
            F.coalesce(F.array_sort(F.array_distinct(members)), F.expr("cast(array() as array<string>)")).alias("members"),
            F.coalesce(F.regexp_count(quoted(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(quoted(id_col), quoted(text_col), F.lit(seed)).alias("draw"),
        ).withColumn("pattern", F.to_json("members")).withColumn("bucket", F.pmod("draw", F.lit(BUCKETS))),
        "mix",
    )
    found = rows.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("size").alias("size")).collect()
    found = sorted((r for r in found if r.members), key=lambda r: r.pattern)
    patterns, sizes = [tuple(r.members) for r in found], [r["size"] for r in found]
    total: dict = defaultdict(int)
    for p, n in zip(patterns, sizes, strict=True):
        for s in p:
            total[s] += n
    target = targets(total, weights, share, repeats)
    flow = min_cost_flow(patterns, sizes, {s: round(t) for s, t in target.items()}, repeats)
    routed: dict = defaultdict(int)
    laid = []
    for r, f in zip(found, flow, strict=True):
        at, parts = 0, []
        for s in sorted(f, key=source_order):
            parts.append((s, at, at + f[s]))
            at += f[s]
            routed[s] += f[s]
        laid.append((r.pattern, r["size"], parts))
    quota = spark.createDataFrame(laid, "pattern string, whole long, parts array<struct<source: string, a: long, b: long>>")
    sources = spark.createDataFrame([(s, total[s], target[s], routed[s]) for s in sorted(total, key=source_order)], "source string, source_size long, target double, routed long")

    inside = Window.partitionBy("pattern", "bucket").orderBy("draw", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("pattern", "bucket").agg(F.sum("size").alias("part")).select("pattern", "bucket", F.coalesce(F.sum("part").over(above), F.lit(0)).alias("base"))
    placed = rows.join(sums, ["pattern", "bucket"]).withColumn("place", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))).join(quota, "pattern", "left")

    def overlap(part: Column) -> Column:
        """Words of a document that fall into one source's stretch, over all copies."""
        return sum(
            (F.greatest(F.lit(0), F.least(F.col("place") + F.col("whole") * c + F.col("size"), part["b"]) - F.greatest(F.col("place") + F.col("whole") * c, part["a"])) for c in range(repeats)),
            F.lit(0).cast("long"),
        )

    by = F.filter(F.transform("parts", lambda p: F.struct(p["source"].alias("source"), overlap(p).cast("long").alias("words"))), lambda x: x["words"] > 0)
    out = placed.select(
        "id", "members", "size", F.coalesce(by, F.array().cast(T.DataType.fromDDL("array<struct<source: string, words: long>>"))).alias("taken_by")
    ).withColumn("taken", F.aggregate("taken_by", F.lit(0).cast("long"), lambda a, x: a + x["words"]))
    return out, sources
