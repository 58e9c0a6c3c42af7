"""Periodic runs of words, by longest common extensions in suffix trees.

A run is a stretch of words with smallest period q that no neighbouring word
extends. Every run holds a Lyndon root: a Lyndon word of length q, in one of
the two alphabet orders, that is the longest one to begin at its place. So the
longest Lyndon words that begin at each place, for both orders, are all
candidates; each is extended to the right and to the left as far as the period
lasts, by two queries for a longest common extension (LCE).

- Lyndon words end where the next smaller suffix begins; the order of the
  suffixes is the order of the leaves of a suffix tree (Ukkonen's algorithm).
- An LCE is the depth of the lowest common ancestor of two leaves. The tour of
  the tree notes, between two leaves, the depth of the node it turns at; the
  least of a stretch of them is the ancestor's, by a sparse table in constant
  time. Extensions to the left take a second tree, of the reversal.

Trees are built for the stretches that can hold a run at all: in a run of four
periods every three consecutive words occur three times or more. Counting
those, again inside each stretch that is left, cuts away most text and no run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_list, quoted, rest_struct
from .quality import once, word_list
from .words import gram_hashes, slices, word_hashes, words_of

#: Words are runs of all bytes but these.
SPACES = (0x20, *range(0x09, 0x0E))
_WORD = np.ones(256, dtype=bool)
_WORD[list(SPACES)] = False
#: Text of one step in a Python task, and words of one tree (a longer stretch
#: has a tree of its own).
SLICE_BYTES = 2 << 20
TREE_WORDS = 20_000
GRAM = 3

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def suffix_tree(text: list[int], symbols: int):
    """Ukkonen's algorithm. ``text`` ends in a symbol found nowhere else.
    Returns the first place and the length of each node's edge, and the edges
    as ``parent * symbols + symbol -> node``; node 0 is the root."""
    n = len(text)
    start, stop, link, child = [0], [0], [0], {}
    node = length = edge = left = 0
    for i, c in enumerate(text):
        left += 1
        waits = 0
        while left:
            if not length:
                edge = i
            key = node * symbols + text[edge]
            to = child.get(key)
            if to is None:
                child[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                if waits:
                    link[waits] = node
                    waits = 0
            else:
                at, end = start[to], stop[to]
                span = end - at
                if length >= span and end != n:
                    edge += span
                    length -= span
                    node = to
                    continue
                if text[at + length] == c:
                    length += 1
                    if waits:
                        link[waits] = node
                    break
                cut = len(start)
                child[key] = cut
                start += (at, i)
                stop += (at + length, n)
                link += (0, 0)
                child[cut * symbols + c] = cut + 1
                start[to] = at + length
                child[cut * symbols + text[at + length]] = to
                if waits:
                    link[waits] = cut
                waits = cut
            left -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - left + 1
    return np.array(start), np.array(stop) - np.array(start), child


def tour(text: list[int], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the depth of the node at which the tour of the
    tree turns between each and the next."""
    start, size, child = suffix_tree(text, symbols)
    keys = np.fromiter(child.keys(), dtype=np.int64, count=len(child))
    to = np.fromiter(child.values(), dtype=np.int64, count=len(child))
    del child
    order = np.argsort(keys)
    to = to[order]
    bounds = np.searchsorted(keys[order] // symbols, np.arange(len(start) + 1))
    last, at = bounds[1:].tolist(), bounds[:-1].tolist()
    n, size, to = len(text), size.tolist(), to.tolist()
    suffixes: list[int] = []
    turns: list[int] = []
    # a node's children, from left to right; the stack holds inner nodes above
    node, depth, above, opened = 0, 0, [], True
    while True:
        k = at[node]
        if k == last[node]:
            if not above:
                break
            node, depth = above.pop()
            opened = False
            continue
        if not opened:
            turns.append(depth)
        at[node] = k + 1
        down = to[k]
        if at[down] == last[down]:  # a leaf
            suffixes.append(n - depth - size[down])
            opened = False
        else:
            above.append((node, depth))
            node, depth, opened = down, depth + size[down], True
    return np.array(suffixes), np.array(turns, dtype=np.int64)


class Extensions:
    """Longest common extensions of pairs of places."""

    def __init__(self, text: list[int], symbols: int):
        suffixes, turns = tour(text, symbols)
        self.rank = np.empty(len(text), dtype=np.int64)
        self.rank[suffixes] = np.arange(len(text))
        self.least = [turns.astype(np.int32)]
        width = 1
        while 2 * width <= len(turns):
            row = self.least[-1]
            self.least.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For different places ``a`` and ``b``."""
        ra, rb = self.rank[a], self.rank[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level).tolist():
            on = np.flatnonzero(level == k)
            row = self.least[k]
            out[on] = np.minimum(row[low[on]], row[high[on] - (1 << k)])
        return out


def next_smaller(rank: list[int]) -> list[int]:
    """The next place of smaller rank; ``len(rank)`` where there is none."""
    out, open_ = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = i
        open_.append(i)
    return out


def runs_of(stretches: list[list[int]], words: int, min_length: int, min_exponent: int) -> np.ndarray:
    """All runs of several sequences of numbers under ``words``: rows of
    sequence, start, length and period, in this order.

    The sequences stand in one text, each between symbols found nowhere else,
    smaller than all words, that no extension passes."""
    marks = len(stretches) + 1
    text, owner, offset = [0], [-1], [1]
    for k, s in enumerate(stretches):
        text += [w + marks for w in s]
        text.append(k + 1)
        owner += [k] * len(s) + [-1 - marks - k]
        offset.append(len(text))
    n, symbols = len(text), words + marks
    owner = np.array(owner)
    right = Extensions(text, symbols)
    first = np.concatenate([next_smaller(right.rank.tolist()), next_smaller((n - 1 - right.rank).tolist())])
    i = np.concatenate([np.arange(n), np.arange(n)])
    on = np.flatnonzero(first < n)
    i, j = i[on], first[on]
    on = np.flatnonzero(owner[i] == owner[j])
    i, j = i[on], j[on]
    p = j - i
    end = j + right(i, j)
    del right
    left = Extensions(text[::-1], symbols)
    # the word before i, seen from the end
    begin = i - left(n - i, n - j)
    size = end - begin
    ok = np.flatnonzero(size >= np.maximum(min_length, min_exponent * p))
    k = owner[i[ok]]
    found = np.stack([k, begin[ok] - np.array(offset)[k], size[ok], p[ok]], axis=1)
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def may_repeat(h: np.ndarray, doc: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """Stretches of words, inside a document, outside which no run lies.

    A run of at least ``min_length`` words and ``min_exponent`` periods holds
    each of its three-word windows this often. Equal words have equal hashes
    ``h``, so a collision can keep a stretch, never cut a run."""
    often = min(min_exponent - 1, max(min_length, min_exponent) - GRAM + 1)
    shortest = max(min_length, min_exponent) - GRAM + 1
    grams = gram_hashes(h, GRAM)
    at = np.flatnonzero(doc[: len(grams)] == doc[GRAM - 1 :]) if len(grams) else np.zeros(0, dtype=np.int64)
    part = doc[at]
    while True:
        before = len(at)
        _, which, count = np.unique(grams[at] ^ (part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
        at = at[count[which] >= often]
        part = np.cumsum(np.diff(at, prepend=-2) != 1)
        at = at[np.bincount(part)[part] >= shortest] if len(at) else at
        part = np.cumsum(np.diff(at, prepend=-2) != 1)
        if len(at) == before:
            break
    opens = np.flatnonzero(np.diff(part, prepend=0))
    closes = np.append(opens[1:], len(at)) - 1
    return [(int(at[a]), int(at[b]) + GRAM) for a, b in zip(opens, closes, strict=True)] if len(at) else []


def find_runs(texts: list[bytes], min_length: int, min_exponent: int):
    """Words of the texts, and rows of text number, start, length and period of
    every run, ordered by text, start and period."""
    buf, starts, stops, doc = words_of(texts, _WORD, lower=False)
    firsts = np.searchsorted(doc, np.arange(len(texts) + 1))
    todo = may_repeat(word_hashes(buf, starts, stops), doc, min_length, min_exponent)
    out = [np.zeros((0, 4), dtype=np.int64)]
    while todo:
        # as many stretches as one tree takes
        total, take = 0, 0
        while take < len(todo) and (not take or total + todo[take][1] - todo[take][0] <= TREE_WORDS):
            total += todo[take][1] - todo[take][0]
            take += 1
        now, todo = todo[:take], todo[take:]
        number: dict[bytes, int] = {}
        numbered = [[number.setdefault(buf[a:b].tobytes(), len(number)) for a, b in zip(starts[x:y].tolist(), stops[x:y].tolist(), strict=True)] for x, y in now]
        rows = runs_of(numbered, len(number), min_length, min_exponent)
        at = np.array([x for x, _ in now])[rows[:, 0]]
        rows[:, 0] = doc[at]
        rows[:, 1] += at - firsts[rows[:, 0]]
        out.append(rows)
    rows = np.unique(np.concatenate(out), axis=0)
    return (buf, starts, stops, doc, firsts), rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def collapse(words, rows: np.ndarray, texts: int) -> pa.Array:
    """The words that no run repeats, joined by one space."""
    buf, starts, stops, doc, firsts = words
    n = len(starts)
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, firsts[rows[:, 0]] + rows[:, 1] + rows[:, 3], 1)
    np.add.at(change, firsts[rows[:, 0]] + rows[:, 1] + rows[:, 2], -1)
    kept = np.flatnonzero(np.cumsum(change[:n]) == 0)
    # each kept word with the byte after it, but for a text's last one
    final = np.append(doc[kept][1:] != doc[kept][:-1], True)[: len(kept)]
    ends = stops[kept] + ~final
    edge = np.zeros(len(buf) + 1, dtype=np.int8)
    edge[starts[kept]] += 1
    np.add.at(edge, ends, -1)
    data = buf.copy()
    data[stops[kept]] = 0x20
    data = data[np.cumsum(edge[:-1], dtype=np.int8) > 0]
    sizes = np.bincount(doc[kept], weights=ends - starts[kept], minlength=texts).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), texts, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def run_rows(min_length: int, min_exponent: int):
    def run(batches):
        for batch in batches:
            texts = binary_list(pa.chunked_array([batch["text"]]))
            for a, b in slices(texts, SLICE_BYTES):
                words, rows = find_runs(texts[a:b], min_length, min_exponent)
                firsts = words[-1]
                bounds = np.searchsorted(rows[:, 0], np.arange(b - a + 1)).astype(np.int32)
                found = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in (1, 2, 3)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch["id"][a:b], pa.array(np.diff(firsts).astype(np.int64)), pa.ListArray.from_arrays(bounds, found).cast(_RUNS), collapse(words, rows, b - a), batch["rest"][a:b]],
                    names=["id", "n_words", "runs", "collapsed", "rest"],
                )

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """Runs of words in each whole text: stretches with smallest period q, of
    at least ``min_length`` words and ``min_exponent`` times q, that no
    neighbouring word extends with that period.

    Returns ``id``, ``n_words``, ``runs`` (array of ``start``, ``length`` and
    ``period`` in words, from 0, by start and period), ``collapsed`` (the words
    that no run holds after its first q words, joined by one space) and
    ``rest`` (a struct of all other columns, whatever their names), a row for
    each input row and no shuffle.

    A NULL or empty text has no words, no runs and an empty ``collapsed``.
    Repeated rows and NULL ids are rows like others. A very long text is taken
    whole; a task's memory follows its longest repetitive stretch (under one
    KB a word), not the text. An empty table gives an empty result.
    """
    if min_exponent < 2 or min_length < GRAM:
        raise ValueError(f"a run needs two periods and {GRAM} words at least")
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), rest_struct(docs, id_col, text_col).alias("rest"))
    schema = T.StructType([rows.schema["id"]]).add("n_words", T.LongType())
    schema = schema.add("runs", T.DataType.fromDDL("array<struct<start: long, length: long, period: long>>")).add("collapsed", T.StringType()).add(rows.schema["rest"])
    return rows.mapInArrow(run_rows(min_length, min_exponent), schema)


def repeat_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with periodic tails planted: where h, the crc32 of the id as
    text, is divisible by ten, the words from number a on repeat the first p of
    them (g = h / 10, a = g % n, p = 1 + (n - a) / (3 + g % 8), whole numbers).
    Other texts, and those without a word or id, stay."""
    rows = docs.select("*", F.struct(F.crc32(quoted(id_col).cast("string").cast("binary")).alias("h"), quoted(text_col).alias("t")).alias("__plant"))
    rows = once(rows, __words=F.when(F.expr("__plant.h % 10 = 0"), word_list(F.expr("__plant.t"))))
    n = F.size("__words").cast("long")
    rows = once(rows, __n=n, __g=F.expr("__plant.h div 10"))
    rows = once(rows, __a=F.expr("if(__n > 0, __g % __n, 0)"))
    rows = once(rows, __p=F.expr("1 + (__n - __a) div (3 + __g % 8)"))
    places = F.expr("sequence(0L, __n - 1)")
    put = F.transform(places, lambda i: F.get("__words", F.when(i < F.col("__a"), i).otherwise(F.col("__a") + (i - F.col("__a")) % F.col("__p")).cast("int")))
    text: Column = F.when(F.col("__n") > 0, F.array_join(put, " ")).otherwise(quoted(text_col))
    return rows.select(*[text.alias(c) if c == text_col else quoted(c) for c in docs.columns])
