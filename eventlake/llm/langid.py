"""Language identification by a linear-chain conditional random field.

Each word of a text gets a language label; neighbouring labels are tied by
learned transition weights, so code-switched text is labelled in runs. Word
features: byte prefixes and suffixes, byte trigrams with word edges, and a
lexicon of frequent training words, all hashed into one weight table. Labels'
probabilities come from forward-backward, over blocks of words at once.

Training uses a bounded, seeded sample: at most TRAIN_ROWS documents for each
language, of each a stretch of at most TRAIN_CHARS characters at a place drawn
by hash. Sequences for training are spliced from stretches of several
languages, so that transitions are learned as well. Prediction covers every
whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_list, mix64, quoted, rest_struct
from .words import slices, word_hashes, words_of

UNDETERMINED = "und"
TRAIN_ROWS = 150
TRAIN_CHARS = 4000
#: Rows are drawn by a hash below this.
DRAWS = 1 << 63
SEQUENCES = 3000
LENGTH = 40
SWITCH = 0.04
STEPS = 40
TABLE = 1 << 17
LEXICON_COUNT = 3
CHUNK = 32
#: Sequences times labels that a training step works on at once.
TRAIN_BLOCK = 4000
#: Bytes of text times labels that are worked on at once.
SLICE = 4 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = _LETTER[128:] = True


def letters(text: str | None) -> str:
    """Lower-cased text, empty if it has no letter."""
    if not text or not any(c.isalpha() for c in text):
        return ""
    return text.lower()


def features(buf: np.ndarray, starts: np.ndarray, stops: np.ndarray, lexicon: np.ndarray):
    """Of the distinct words: table rows of the affix and lexicon features (one
    row of the result a feature) and of the trigrams (flat, with each word's
    first); then each word's number among the distinct ones, and their hashes."""
    clean = np.concatenate((np.full(8, 32, np.uint8), np.where(_LETTER[buf], buf, np.uint8(32)), np.full(8, 32, np.uint8)))
    grams = np.ndarray((len(clean) - 7,), dtype="<u8", buffer=clean, strides=(1,))
    h, one, of, times = np.unique(word_hashes(clean, starts + 8, stops + 8), return_index=True, return_inverse=True, return_counts=True)
    starts, stops = starts[one], stops[one]
    head, tail, size = grams[starts + 8], grams[stops], stops - starts
    rows = []
    for n in (1, 2, 3):
        rows.append((head & np.uint64((1 << (8 * n)) - 1)) ^ np.uint64(n << 56))
    for n in (1, 2, 3, 4):
        rows.append((tail >> np.uint64(64 - 8 * n)) ^ np.uint64((n + 8) << 56))
    known = lexicon[np.minimum(np.searchsorted(lexicon, h), max(len(lexicon) - 1, 0))] == h if len(lexicon) else np.zeros(len(h), bool)
    rows.append(np.where(known, h, np.uint64(1)))
    words = np.array([mix64(r.copy()) % np.uint64(TABLE) for r in rows], dtype=np.int64).reshape(len(rows), len(h))
    first = np.cumsum(size) - size
    before = np.repeat(starts + 7 - first, size) + np.arange(int(size.sum()))
    tri = grams[before] & np.uint64(0xFFFFFF)
    tri = (mix64(tri ^ np.uint64(31 << 56)) % np.uint64(TABLE)).astype(np.int64)
    return words, tri, first, of, h, times


def scores(weights: np.ndarray, words: np.ndarray, tri: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.add.reduceat(weights[tri], first, axis=0) if len(first) else np.zeros((0, weights.shape[1]), weights.dtype)
    for row in words:
        out += weights[row]
    return out


def likely(e: np.ndarray) -> np.ndarray:
    """Scores as weights of at most 1, and never under e^-20."""
    return np.exp(np.maximum(e - e.max(axis=-1, keepdims=True), -20.0))


def passes(e: np.ndarray, unused: list[np.ndarray], move: np.ndarray, before: np.ndarray, after: np.ndarray):
    """Forward and backward weights (scaled) in sequences side by side.

    e: (steps, sequences, labels); unused: at each step, the sequences that
    lack it; before, after: the weights that come in at either end."""
    forward, backward = np.empty_like(e), np.empty_like(e)
    a = before
    for t in range(len(e)):
        nxt = (a @ move) * e[t]
        nxt /= nxt.sum(axis=1, keepdims=True)
        nxt[unused[t]] = a[unused[t]]
        forward[t] = a = nxt
    b = after
    for t in range(len(e) - 1, -1, -1):
        backward[t] = b
        nxt = (e[t] * b) @ move.T
        nxt /= nxt.sum(axis=1, keepdims=True)
        nxt[unused[t]] = b[unused[t]]
        b = nxt
    return forward, backward


def marginals(e: np.ndarray, counts: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Label probabilities of each word, from weights ``e`` of the words;
    ``counts``: words of each text.

    A text's words are cut into chunks. A chunk's effect is a matrix; the
    matrices carry the weights from chunk to chunk, and a last pass fills in
    the words, all chunks at once."""
    labels = e.shape[1]
    counts = counts[counts > 0]
    per = -(-counts // CHUNK)
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), per)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    at = first[text] + nth * CHUNK
    step = at[None, :] + np.arange(CHUNK)[:, None]
    used = step < (first + counts)[text][None, :]
    unused = [np.flatnonzero(~u) for u in used]
    block = e[np.minimum(step, len(e) - 1)]
    effect = np.broadcast_to(np.eye(labels, dtype=e.dtype), (len(at), labels, labels)).copy()
    for t in range(CHUNK):
        nxt = (effect.reshape(-1, labels) @ move).reshape(effect.shape)
        nxt *= block[t][:, None, :]
        if t % 4 == 3:
            nxt /= nxt.max(axis=(1, 2), keepdims=True)
        nxt[unused[t]] = effect[unused[t]]
        effect = nxt
    before = np.full((len(at), labels), 1.0 / labels, dtype=e.dtype)
    after = before.copy()
    head = np.cumsum(per) - per
    order = np.argsort(-per, kind="stable")
    many = per[order]
    for k in range(1, int(per.max()) if len(per) else 0):
        now = head[order[: np.searchsorted(-many, -k, side="left")]] + k
        v = np.einsum("ni,nij->nj", before[now - 1], effect[now - 1])
        before[now] = v / v.sum(axis=1, keepdims=True)
    for k in range((int(per.max()) if len(per) else 0) - 2, -1, -1):
        now = head[order[: np.searchsorted(-many, -(k + 1), side="left")]] + k
        v = np.einsum("nij,nj->ni", effect[now + 1], after[now + 1])
        after[now] = v / v.sum(axis=1, keepdims=True)
    p, backward = passes(block, unused, move, before, after)
    p *= backward
    p /= p.sum(axis=2, keepdims=True)
    out = np.empty_like(e)
    out[step[used]] = p[used]
    return out


def expected(e: np.ndarray, pick: np.ndarray, target: np.ndarray, move: np.ndarray):
    """Of the sequences ``pick`` (word numbers, place by sequence): expected less
    true labels, summed for each word, and expected transitions.

    Transitions are summed over places as a product of two matrices, and
    sequences go in blocks, so memory doesn't grow with the labels squared."""
    labels = e.shape[1]
    per_word = np.zeros((len(e), labels))
    moved = np.zeros((labels, labels))
    unused = [np.zeros(0, dtype=np.int64)] * len(pick)
    block = max(1, TRAIN_BLOCK // labels)
    for at in range(0, pick.shape[1], block):
        words, true = pick[:, at : at + block], target[:, at : at + block]
        here = e[words]
        edge = np.full((words.shape[1], labels), 1.0 / labels, dtype=e.dtype)
        forward, backward = passes(here, unused, move, edge, edge)
        into = here[1:] * backward[1:]
        weight = ((forward[:-1] @ move) * into).sum(axis=2, keepdims=True)
        moved += move * ((forward[:-1] / weight).reshape(-1, labels).T @ into.reshape(-1, labels))
        forward *= backward
        forward /= forward.sum(axis=2, keepdims=True)
        np.add.at(forward, (*np.indices(true.shape), true), -1)
        flat = words.ravel()
        for j in range(labels):
            per_word[:, j] += np.bincount(flat, weights=forward[:, :, j].ravel(), minlength=len(e))
    return per_word, moved


def train(samples: dict[str, list[str]], seed: int = 7):
    """Labels, weight table, transition weights and lexicon, from stretches of
    text for each label. One label needs no weights."""
    names = sorted(samples)
    labels = len(names)
    rng = np.random.default_rng(seed)
    texts = [letters(t).encode() for n in names for t in samples[n]]
    owner = np.array([i for i, n in enumerate(names) for _ in samples[n]], dtype=np.int64)
    buf, starts, stops, doc = words_of(texts, _LETTER, lower=False)
    weights = np.zeros((TABLE, labels), dtype=np.float32)
    trans = np.zeros((labels, labels), dtype=np.float32)
    *_, h, times = features(buf, starts, stops, np.zeros(0, np.uint64))
    lexicon = h[times >= LEXICON_COUNT]
    if labels < 2 or not len(starts):
        return names, weights, trans, lexicon
    words, tri, first, of, h, _ = features(buf, starts, stops, lexicon)
    label = owner[doc]
    streams = [np.flatnonzero(label == i) for i in range(labels)]
    alive = [i for i in range(labels) if len(streams[i])]
    pick = np.empty((SEQUENCES, LENGTH), dtype=np.int64)
    for s in range(SEQUENCES):
        now, at = alive[s % len(alive)], 0
        while at < LENGTH:
            n = min(LENGTH - at, int(rng.geometric(SWITCH)))
            pick[s, at : at + n] = streams[now][(int(rng.integers(len(streams[now]))) + np.arange(n)) % len(streams[now])]
            at += n
            now = alive[int(rng.integers(len(alive)))]
    pick = pick.T
    target = label[pick]
    pick = of[pick]
    size = np.append(first[1:], len(tri)) - first
    seen = np.zeros((labels, labels))
    np.add.at(seen, (target[:-1].ravel(), target[1:].ravel()), 1)
    first_moment = [np.zeros_like(weights), np.zeros_like(trans)]
    second = [np.zeros_like(weights), np.zeros_like(trans)]
    word_of_tri = np.repeat(np.arange(len(first)), size)
    for step in range(1, STEPS + 1):
        per_word, moved = expected(likely(scores(weights, words, tri, first)), pick, target, np.exp(trans))
        grad = np.zeros_like(weights)
        for j in range(labels):
            for row in words:
                grad[:, j] += np.bincount(row, weights=per_word[:, j], minlength=TABLE)
            grad[:, j] += np.bincount(tri, weights=per_word[word_of_tri, j], minlength=TABLE)
        gradients = [grad + 0.01 * weights, (moved - seen).astype(np.float32) + trans]
        for value, g, m, v in zip((weights, trans), gradients, first_moment, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return names, weights, trans, lexicon


def predict(model, with_runs: bool):
    def run(batches):
        names, weights, trans, lexicon = model.value
        move = np.exp(trans)
        for batch in batches:
            column = batch["text"]
            raw = binary_list(pa.chunked_array([column]))
            pred, score, runs = [UNDETERMINED] * len(raw), [0.0] * len(raw), [None] * len(raw)
            for lo, hi in slices(raw, SLICE // max(2, len(names))):
                texts = [letters(t.decode("utf-8", "replace")).encode() for t in raw[lo:hi]]
                buf, starts, stops, doc = words_of(texts, _LETTER, lower=False)
                if not names or not len(starts):
                    continue
                words, tri, first, of, *_ = features(buf, starts, stops, lexicon)
                counts = np.bincount(doc, minlength=hi - lo)
                p = marginals(likely(scores(weights, words, tri, first))[of], counts, move)
                some = np.flatnonzero(counts)
                heads = np.cumsum(counts[some]) - counts[some]
                mean = np.add.reduceat(p.astype(np.float64), heads, axis=0) / counts[some][:, None]
                best = mean.argmax(axis=1)
                for i, b, m in zip(some.tolist(), best.tolist(), mean[np.arange(len(some)), best].tolist(), strict=True):
                    pred[lo + i], score[lo + i] = names[b], min(1.0, max(0.0, m))
                if with_runs:
                    tag = p.argmax(axis=1)
                    for i, a, n in zip(some.tolist(), heads.tolist(), counts[some].tolist(), strict=True):
                        cut = [0, *(np.flatnonzero(np.diff(tag[a : a + n])) + 1).tolist(), n]
                        runs[lo + i] = [{"start": x, "end": y, "lang": names[tag[a + x]]} for x, y in zip(cut, cut[1:], strict=False)]
            out = {"lang_pred": pa.array(pred), "score": pa.array(score, pa.float64())}
            names_out = ["id", "text", "lang_pred", "score", "rest"]
            if with_runs:
                out["runs"] = pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])))
                names_out.append("runs")
            yield pa.RecordBatch.from_arrays([out.get(c, batch[c] if c in batch.schema.names else None) for c in names_out], names=names_out)

    return run


def held_out(doc_id: Column) -> Column:
    """Is a document kept from training: crc32 of its id as text, mod 4, is 2.
    A NULL id is not held out, but is not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def largest_draw(n: int) -> int:
    """The largest hash, of 63 bits, with which one of ``n`` rows is drawn."""
    return min(DRAWS, 2 * TRAIN_ROWS * DRAWS // n) - 1


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str):
    """Train on a sample of the documents that are not held out."""
    key, text, lang = quoted(id_col), quoted(text_col), quoted(lang_col)
    rows = docs.where(key.isNotNull() & ~held_out(key) & (F.length(text) > 0) & lang.isNotNull()).select(
        lang.alias("lang"), text.alias("text"), F.xxhash64(key, text).alias("draw")
    )
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    share = F.lit(-1).cast("long")
    for name, n in sizes.items():  # about twice the rows wanted, then cut to the bound by hash
        share = F.when(F.col("lang") == name, F.lit(largest_draw(n))).otherwise(share)
    place = F.pmod("draw", F.greatest(F.length("text") - TRAIN_CHARS, F.lit(0)) + 1).cast("int") + 1
    drawn = rows.where(F.xxhash64("draw").bitwiseAND(F.lit(DRAWS - 1)) <= share).select("lang", "draw", F.substr("text", place, F.lit(TRAIN_CHARS)).alias("part")).collect()
    samples: dict[str, list[str]] = {}
    for r in sorted(drawn, key=lambda r: (r.draw, r.part)):
        of = samples.setdefault(r.lang, [])
        if len(of) < TRAIN_ROWS:
            of.append(r.part)
    if missing := set(sizes) - set(samples):
        raise ValueError(f"no training row was drawn for {sorted(missing)}")
    return train(samples)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", runs: bool = False) -> DataFrame:
    """The language of each whole text, learned from the rows' own labels.

    Returns ``id``, ``text``, ``lang_pred``, ``score`` (mean probability of
    that label over the words, 0 to 1) and ``rest`` (a struct of the other
    columns), a row for each input row; with ``runs`` also the word ranges
    [start, end) of one language (array of structs; NULL if undetermined).

    A NULL text or one without a letter is ``und`` with score 0; so is every
    text if there is nothing to learn from. Equal texts get equal results.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, id_col, text_col, lang_col))
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), rest_struct(docs, id_col, text_col).alias("rest"))
    schema = T.StructType([rows.schema["id"], rows.schema["text"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), rows.schema["rest"]])
    if runs:
        schema = schema.add("runs", T.DataType.fromDDL("array<struct<start: long, end: long, lang: string>>"))
    return rows.mapInArrow(predict(model, runs), schema)
