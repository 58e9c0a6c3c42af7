"""Near-duplicate documents by ordered MinHash, verified by banded alignment.

A document is its sequence of SHINGLE-word shingles, each labelled with its
occurrence number. A sketch takes the LENGTH shingles with the smallest hashes
under one hash function and keeps them in text order, so it tends to agree for
texts that agree in order. SKETCHES sketches make a band; documents that agree
in one of BANDS bands are candidates. At similarity 0.8 a band agrees with
probability 0.8^6, and one of 24 does with probability over 0.999.

Similarity is that of the aligned sequences: with A shingles matched in order,
A / (n1 + n2 - A). Similarity s bounds the unmatched shingles, and so the
width of the band around the diagonal that the alignment needs.

Equal texts are one node. Within a bucket, nodes are first compared to a hub,
not to each other, and the buckets of a group take several hubs. In buckets
that still hold several components, every pair across components is either
excluded by a bound or compared: lengths and parity bitmaps bound the shingles
that two nodes don't share from below. Pairs are compared by rising bound, and
pairs that others have tied meanwhile are left out. So two similar nodes that
share a bucket always end in one group.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import NO_ID, binary_list, mix64, quoted, rest_struct, stored
from .words import gram_hashes, slices, word_hashes, words_of

SHINGLE = 5
SIMILARITY = 0.8
LENGTH = 3
SKETCHES = 2
BANDS = 24
#: Different hubs that the buckets of a group take.
ORDERS = 6
#: A bucket left open is held against itself in blocks of about so many nodes.
BLOCK = 512
#: Steps of the bound in which pairs are compared.
STEPS = 3
SLICE_BYTES = 1 << 20

_SALTS = mix64(np.arange(1, BANDS * SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(texts: list[bytes]) -> list[np.ndarray]:
    """Occurrence-labelled shingle hashes of each text, in order. Fewer words
    than SHINGLE make one shingle; no words, none."""
    buf, starts, stops, doc = words_of(texts)
    h = word_hashes(buf, starts, stops)
    grams = gram_hashes(h, SHINGLE)
    n = np.bincount(doc, minlength=len(texts))
    base = np.cumsum(n) - n
    out = []
    for a, k in zip(base.tolist(), n.tolist(), strict=True):
        if k >= SHINGLE:
            out.append(labelled(grams[a : a + k - SHINGLE + 1]))
        else:
            out.append(gram_hashes(h[a : a + k], k) if k else h[:0])
    return out


def labelled(grams: np.ndarray) -> np.ndarray:
    """Hashes that tell equal shingles apart by occurrence number."""
    order = np.argsort(grams, kind="stable")
    g = grams[order]
    new = np.concatenate(([True], g[1:] != g[:-1]))
    if new.all():
        return grams
    at = np.arange(len(g))
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    out = np.empty_like(grams)
    out[order] = np.where(nth > 0, mix64(g ^ (nth.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))), g)
    return out


def bands(x: np.ndarray) -> np.ndarray:
    """Band hashes of a document's labelled shingles."""
    keep = min(LENGTH, len(x))
    at_once = max(1, (1 << 20) // len(x))
    sketch = []
    for lo in range(0, len(_SALTS), at_once):
        y = x[None, :] * _SALTS[lo : lo + at_once, None]
        y ^= y >> np.uint64(32)
        y *= np.uint64(0xD6E8FEB86659FD93)
        least = np.argpartition(y, keep - 1, axis=1)[:, :keep] if keep < len(x) else np.tile(np.arange(len(x)), (len(y), 1))
        least.sort(axis=1)
        h = np.zeros(len(least), dtype=np.uint64)
        for j in range(keep):
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + x[least[:, j]])
        sketch.append(h)
    both = np.concatenate(sketch).reshape(BANDS, SKETCHES)
    out = np.zeros(BANDS, dtype=np.uint64)
    for j in range(SKETCHES):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + both[:, j])
    return out.view(np.int64)


def similarity(x: np.ndarray, y: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned similarity of two labelled shingle sequences, or 0 if it is
    under ``least``."""
    if not len(x) or not len(y):
        return 0.0
    total = len(x) + len(y)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= total * (1 - least) / (1 + least)
    i, j = i[near], j[near]
    if len(i) < least * (total - len(i)):
        return 0.0
    j = j[np.argsort(i)]
    matched = len(j)
    if (np.diff(j) < 0).any():  # longest run that keeps both orders
        tails: list[int] = []
        for v in j.tolist():
            at = bisect_left(tails, v)
            tails[at : at + 1] = [v]
        matched = len(tails)
    return matched / (total - matched) if matched >= least * (total - matched) else 0.0


def sketch_rows(batches):
    for batch in batches:
        texts = binary_list(pa.chunked_array([batch["text"]]))
        found = []
        for lo, hi in slices(texts, SLICE_BYTES):
            found += [bands(x) if len(x) else None for x in shingles(texts[lo:hi])]
        yield pa.RecordBatch.from_arrays([batch["id"], batch["node"], pa.array(found, pa.list_(pa.int64()))], names=["id", "node", "bands"])


def compare_rows(least: float):
    def run(batches):
        for batch in batches:
            a, b = (binary_list(pa.chunked_array([batch[c]])) for c in ("text_a", "text_b"))
            keep = []
            for lo, hi in slices(a, SLICE_BYTES):
                for k, (x, y) in enumerate(zip(shingles(a[lo:hi]), shingles(b[lo:hi]), strict=True), lo):
                    if similarity(x, y, least) > 0:
                        keep.append(k)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["a"].take(rows), batch["b"].take(rows)], names=["a", "b"])

    return run


def parity(x: np.ndarray) -> bytes:
    """Bitmap of a set of hashes, a bit for each residue that an odd number of
    them has. Bits that differ are never more than members that differ."""
    width = max(64, 1 << (4 * len(x) - 1).bit_length())
    odd = np.bincount((mix64(x) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def parity_rows(batches):
    for batch in batches:
        texts = binary_list(pa.chunked_array([batch["text"]]))
        n, bits = [], []
        for lo, hi in slices(texts, SLICE_BYTES):
            for x in shingles(texts[lo:hi]):
                n.append(len(x))
                bits.append(parity(x) if len(x) else b"")
        yield pa.RecordBatch.from_arrays([batch["node"], pa.array(n, pa.int64()), pa.array(bits, pa.binary())], names=["node", "n", "bits"])


def close_pairs(group: pa.Table, least: float) -> tuple[list, list, list]:
    """Pairs of a block, across components and parts, that no bound excludes,
    with the step of their bound. Bitmaps of unlike width are folded to the
    smaller one; lengths within the bound differ by one fold at most."""
    limit = (1 - least) / (1 + least)
    node, n, part = group["node"].to_pylist(), group["n"].to_numpy(), group["part"].to_numpy()
    comp = group["comp"].combine_chunks().dictionary_encode().indices.to_numpy()
    cross = all(group["cross"].to_pylist())
    raw = group["bits"].to_pylist()
    by_width: dict[int, list[int]] = {}
    for k, b in enumerate(raw):
        by_width.setdefault(len(b), []).append(k)
    a, b, step = [], [], []
    for width, here in by_width.items():
        rows = np.frombuffer(b"".join(raw[k] for k in here), np.uint64).reshape(len(here), -1)
        wide = by_width.get(2 * width, [])
        if wide:
            both = np.frombuffer(b"".join(raw[k] for k in wide), np.uint64).reshape(len(wide), 2, -1)
            rows = np.concatenate((rows, both[:, 0] ^ both[:, 1]))
        at = np.array(here + wide)
        for i in range(len(here)):
            k, others = at[i], at[i + 1 :]
            ok = (comp[others] != comp[k]) & (np.minimum(n[others], n[k]) >= least * np.maximum(n[others], n[k]))
            if cross:
                ok &= part[others] != part[k]
            some = np.flatnonzero(ok)
            if not len(some):
                continue
            others = others[some]
            apart = np.bitwise_count(rows[i + 1 + some] ^ rows[i]).sum(axis=1, dtype=np.int64)
            share = apart / (limit * (n[others] + n[k]))
            for j, x in zip(others[share <= 1 + 1e-9].tolist(), share[share <= 1 + 1e-9].tolist(), strict=True):
                a.append(min(node[k], node[j]))
                b.append(max(node[k], node[j]))
                step.append(min(STEPS - 1, int(x * STEPS)))
    return a, b, step


def close_rows(least: float):
    """``close_pairs`` of each key; rows come sorted by key."""

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
            lo, found = 0, ([], [], [])
            for hi in (np.flatnonzero(np.diff(table["key"].to_numpy())) + 1).tolist():
                for all_, new in zip(found, close_pairs(table.slice(lo, hi - lo), least), strict=True):
                    all_ += new
                lo = hi
            rest = table.slice(lo)
            yield pairs(found)
        if rest is not None and len(rest):
            yield pairs(close_pairs(rest, least))

    def pairs(found):
        a, b, step = found
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(step, pa.int32())], names=["a", "b", "step"])

    return run


def node_key(text: Column) -> Column:
    """One key for equal texts: half a SHA-256."""
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``stored``, with some figures taken while it is written."""
    seen = Observation()
    out = stored(df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), name)
    return out, seen.get


def components(links: DataFrame) -> DataFrame:
    """``node``, ``comp``: of each linked node, the node that stands for all it
    reaches. Each node points to its smallest neighbour, pointers are followed
    to their roots, and the links between roots go on to the next round."""
    count = F.count(F.lit(1))
    edges, seen = observed(links.select(*ordered(F.col("a"), F.col("b"))).where("a != b").distinct(), "edges", n=count)
    found = None
    while seen["n"]:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        up = stored(both.groupBy("node").agg(F.min("other").alias("up")).select("node", F.least("node", "up").alias("up")), "parents")
        moved = 1
        while moved:
            above = up.select(F.col("node").alias("at"), F.col("up").alias("far"))
            step = up.join(above, F.col("up") == F.col("at")).select("node", F.col("far").alias("up"), (F.col("far") != F.col("up")).alias("moved"))
            up, jumped = observed(step, "parents", moved=F.max(F.col("moved").cast("int")))
            up, moved = up.select("node", "up"), jumped["moved"]
        roots = lambda c: up.select(F.col("node").alias(c), F.col("up").alias(f"root_{c}"))  # noqa: B023, E731
        edges = edges.join(roots("a"), "a").join(roots("b"), "b").select(*ordered(F.col("root_a"), F.col("root_b"))).where("a != b").distinct()
        edges, seen = observed(edges, "edges", n=count)
        at = up.select(F.col("node").alias("comp"), "up")
        found = up.select("node", F.col("up").alias("comp")) if found is None else found.join(at, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp"))
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return stored(found, "components")


def hub_pairs(members: DataFrame, order: Column) -> DataFrame:
    """Pairs of each node with its bucket's hub, each once. Buckets differ in
    which node they take, so a node meets several hubs of a group."""
    hubs = members.groupBy("bucket").agg(F.min(F.struct(order.alias("draw"), "node"))["node"].alias("hub"))
    return members.join(hubs, "bucket").where("node != hub").select(*ordered(F.col("node"), F.col("hub"))).distinct()


def crowded(flat: DataFrame) -> DataFrame:
    """The rows (bucket, node) whose bucket holds several."""
    several = flat.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return flat.join(several, "bucket")


def linked(docs: DataFrame, rows: DataFrame, least: float) -> DataFrame:
    """Components over nodes that share a band and are similar; ``rows`` has
    id, node and bands."""
    nodes = stored(rows.where("bands is not null").groupBy("node").agg(F.min("id").alias("id"), F.first("bands").alias("bands")), "nodes")
    flat = nodes.select("node", F.posexplode("bands").alias("band", "hash")).select(F.xxhash64("band", "hash").alias("bucket"), "node", "band")
    members = stored(crowded(flat), "buckets")
    texts = stored(
        docs.join(members.select("node").distinct().join(nodes.select("node", "id"), "node"), ["node", "id"]).select("node", "text").dropDuplicates(["node"]), "texts"
    )

    def similar(pairs: DataFrame) -> DataFrame:
        with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        both = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")
        return stored(both.mapInArrow(compare_rows(least), "a binary, b binary"), "links")

    pairs = stored(hub_pairs(members, F.xxhash64("node", F.col("band") % ORDERS)), "pairs")
    links = similar(pairs)
    comps = components(links)

    # buckets that the hubs left in several components: each pair across them is excluded or compared
    of = members.join(comps, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
    open_ = of.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size")).where("lo != hi")
    of = stored(of.join(open_.select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts")), "bucket"), "open")
    bits = stored(texts.join(of.select("node").distinct(), "node").mapInArrow(parity_rows, "node binary, n long, bits binary"), "bits")
    part = of.withColumn("part", F.pmod(F.xxhash64("node", "bucket"), F.col("parts")).cast("int"))
    dealt = part.select("bucket", "node", "comp", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    keyed = dealt.select(F.xxhash64("bucket", F.least("part", "other"), F.greatest("part", "other")).alias("key"), (F.col("part") != F.col("other")).alias("cross"), "node", "comp", "part")
    blocks = keyed.join(bits, "node").select("key", "cross", "node", "comp", "part", "n", "bits").repartition("key").sortWithinPartitions("key")
    close = blocks.mapInArrow(close_rows(least), "a binary, b binary, step int").distinct().join(pairs, ["a", "b"], "left_anti")
    close, seen = observed(close, "pairs", **{f"n{k}": F.count_if(F.col("step") == k) for k in range(STEPS)})
    for k in range(STEPS):
        if not seen[f"n{k}"]:
            continue
        own = lambda c, comps=comps: comps.select(F.col("node").alias(c), F.col("comp").alias(f"comp_{c}"))
        apart = close.where(F.col("step") == k).join(own("a"), "a", "left").join(own("b"), "b", "left").where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b"))
        links = links.union(similar(apart.select("a", "b")))
        comps = components(links)
    return comps


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """Groups of near-duplicate documents.

    Returns ``id``, ``node`` (key of the text; NULL for NULL text), ``class_id``
    (the smallest id of the group) and ``class_size`` (rows of the group), a row
    for each input row. A group is what links of similarity ``least`` or more
    connect.

    Texts without a word (NULL, empty, only signs) are duplicates of nothing.
    Equal texts with words are in one group, whatever their ids; fewer words
    than SHINGLE match only as a whole. A NULL id is larger than all others.
    """
    return _grouped(docs, id_col, text_col, least).select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("id"), "node", F.when(F.col("class_id") != NO_ID, F.col("class_id")).alias("class_id"), "class_size"
    )


def _grouped(docs: DataFrame, id_col: str, text_col: str, least: float) -> DataFrame:
    text = quoted(text_col)
    slim = docs.select(F.coalesce(quoted(id_col).cast("long"), F.lit(NO_ID)).alias("id"), node_key(text).alias("node"), text.alias("text"))
    rows = stored(slim.mapInArrow(sketch_rows, "id long, node binary, bands array<long>"), "sketches")
    comps = linked(slim, rows, least)
    nodes = rows.where("bands is not null").groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    nodes = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    classes = nodes.groupBy("comp").agg(F.min("id").alias("class_id"), F.sum("n").alias("class_size"), F.min(F.struct("id", "node"))["node"].alias("first"))
    by_node = nodes.select("node", "comp").join(classes, "comp").select("node", "class_id", "class_size", "first")
    out = rows.select("id", "node", F.when(F.col("bands").isNotNull(), F.col("node")).alias("k")).join(by_node.withColumnRenamed("node", "k"), "k", "left")
    return out.select("id", "node", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"), "first")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (of equal
    ids, the smallest text key). Texts without a word all stay."""
    found = _grouped(docs, id_col, text_col, least)
    kept = found.where("first is not null and node = first and id = class_id").select("id", "node").distinct()
    text = quoted(text_col)
    keyed = docs.select(
        F.coalesce(quoted(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(node_key(text), F.lit(b"")).alias("node"), rest_struct(docs).alias("rest")
    )
    alone = found.where("first is null").select("id", F.coalesce("node", F.lit(b"")).alias("node")).distinct()
    one = keyed.join(kept, ["id", "node"]).dropDuplicates(["id", "node"])
    return one.union(keyed.join(alone, ["id", "node"], "left_semi")).select(*[F.col("rest")[c].alias(c) for c in docs.columns])
