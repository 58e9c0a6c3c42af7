"""Benchmark decontamination by winnowing.

A document and a benchmark item share a passage if they share a window:
WINDOW consecutive words, or the whole item if it is shorter. Of every WINDOW
words the smallest hashed GRAM-word string is a fingerprint, so a shared
window always shares a fingerprint. Document fingerprints are looked up among
the items', and each hit is extended to the windows around it, which are
compared word by word.

The benchmark is cut into blocks of at most ``block_bytes`` of text; a block
goes to all tasks, and the documents pass by it. One block needs one pass over
the documents and no shuffle; more blocks need a pass each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_list, quoted, rest_struct, stored, text_bytes
from .words import gram_hashes, slices, word_hashes, words_of

WINDOW = 13
GRAM = 7
REACH = WINDOW - GRAM + 1
SLICE_BYTES = 1 << 20


def fingerprints(h: np.ndarray, doc: np.ndarray):
    """Winnowing: places and hashes of the smallest GRAM-word string of every
    WINDOW words that lie within one text (the first among equals)."""
    if len(h) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = gram_hashes(h, GRAM)
    inside = np.flatnonzero(doc[: len(doc) - WINDOW + 1] == doc[WINDOW - 1 :])
    best = inside.copy()
    low = grams[inside]
    for j in range(1, REACH):
        g = grams[inside + j]
        less = g < low
        low = np.where(less, g, low)
        best[less] = inside[less] + j
    place = np.unique(best)
    return place, grams[place]


class Items:
    """Windows of a block of benchmark items, by content and by hash."""

    def __init__(self, items: list[tuple[str | None, bytes]]):
        self.windows: dict[bytes, set[str]] = {}
        texts = [t for _, t in items]
        buf, starts, stops, doc = words_of(texts)
        h = word_hashes(buf, starts, stops)
        self.prints = np.unique(fingerprints(h, doc)[1])
        first = np.searchsorted(doc, np.arange(len(items) + 1))
        sizes: dict[int, list[int]] = {}
        for i, (item, _) in enumerate(items):
            lo, hi = int(first[i]), int(first[i + 1])
            m = min(WINDOW, hi - lo)
            if not m:
                continue
            words = [buf[a:b].tobytes() for a, b in zip(starts[lo:hi], stops[lo:hi], strict=True)]
            for j in range(len(words) - m + 1):
                owners = self.windows.setdefault(b" ".join(words[j : j + m]), set())
                if item is not None:
                    owners.add(item)
                sizes.setdefault(m, []).append(lo + j)
        #: by window size: the sorted hashes of the windows
        self.hashes = {m: np.unique(gram_hashes(h, m)[np.array(at)]) for m, at in sizes.items()}


def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def occurrences(h: np.ndarray, doc: np.ndarray, items: Items):
    """Places and sizes of windows whose hash an item's window has."""
    for m, ordered in items.hashes.items():
        if len(h) < m:
            continue
        if m == WINDOW:
            place, value = fingerprints(h, doc)
            hit = place[among(value, items.prints)]
            at = np.unique((hit[:, None] - np.arange(REACH)[None, :]).ravel())
            at = at[(at >= 0) & (at + m <= len(h))]
        else:
            at = np.arange(len(h) - m + 1)
        at = at[doc[at] == doc[at + m - 1]]
        value = np.zeros(len(at), dtype=np.uint64)
        if m == WINDOW:
            value = gram_hashes_at(h, at, m)
        else:
            value = gram_hashes(h, m)[at]
        yield m, at[among(value, ordered)]


def gram_hashes_at(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """``gram_hashes`` at some places only."""
    if not len(at):
        return np.zeros(0, dtype=np.uint64)
    rows = h[at[:, None] + np.arange(k)[None, :]]
    padded = np.concatenate(rows)
    return gram_hashes(padded, k)[::k]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans [start, end) joined where they touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def scan(block) -> callable:
    """Adds one block's hits to ``spans`` and ``items`` of each document."""

    def run(batches):
        items = Items(block.value)
        for batch in batches:
            texts = binary_list(pa.chunked_array([batch["text"]]))
            counts, spans, owners = [], batch["spans"].to_pylist(), batch["items"].to_pylist()
            for lo, hi in slices(texts, SLICE_BYTES):
                buf, starts, stops, doc = words_of(texts[lo:hi])
                n = np.bincount(doc, minlength=hi - lo)
                counts += n.tolist()
                base = np.cumsum(n) - n
                h = word_hashes(buf, starts, stops)
                for m, places in occurrences(h, doc, items):
                    for at in places.tolist():
                        content = b" ".join(buf[starts[i] : stops[i]].tobytes() for i in range(at, at + m))
                        if content in items.windows:
                            d = int(doc[at])
                            a = at - int(base[d])
                            spans[lo + d].append({"start": a, "end": a + m})
                            owners[lo + d] += items.windows[content]
            spans = [[{"start": a, "end": b} for a, b in merged([(s["start"], s["end"]) for s in row])] if row else row for row in spans]
            owners = [sorted(set(row)) for row in owners]
            columns = {
                "n_words": pa.array(counts, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "items": pa.array(owners, pa.list_(pa.string())),
            }
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([columns.get(c, batch[c]) for c in names], names=names)

    return run


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """Where each document holds benchmark passages.

    Returns ``id``, ``text``, ``n_words``, ``spans`` (array of word ranges
    [start, end) inside occurring windows, joined where they touch), ``items``
    (ids of the items, as strings, distinct, sorted) and ``rest`` (a struct of
    the other columns), a row for each input row.

    NULL or empty texts have no words, spans or items; an item without words
    has no window. An item without an id marks words but isn't listed. Repeated
    rows are judged alike. An empty benchmark leaves all documents clean.
    """
    spark = docs.sparkSession
    out = docs.select(
        quoted(id_col).alias("id"),
        quoted(text_col).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<start: long, end: long>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
        rest_struct(docs, id_col, text_col).alias("rest"),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema])
    wanted = benchmark.select(quoted(item_col).cast("string").alias("item"), quoted(item_text_col).alias("text")).where(F.length("text") > 0).distinct()
    blocks = max(1, -(-text_bytes(wanted, "text") // block_bytes))
    for i in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == i).collect()
        block = spark.sparkContext.broadcast(sorted(((r.item, r.text.encode()) for r in rows), key=str))
        out = out.mapInArrow(scan(block), schema)
        if i + 1 < blocks:
            out = stored(out, "decontaminate")
    return out
