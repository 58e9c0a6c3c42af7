"""A hidden Markov language model: Baum-Welch training, exact likelihoods.

Tokens are words and one end for each text. A state emits a class, and the
class a token. A word with a large enough share of the training tokens is a
class of its own (there can be at most ``OWN`` of them); every other word falls
into a class by its form (its length, first and last bytes), and its share of
the class follows from its count, with one place in each class for all unseen
words. So every word's count matters, while the states' tables have a fixed size.

1. Texts become blocks: tokens as numbers of the block's own words. Each block
   sends every word once, with its count, to the word's bucket; the buckets add
   up and send the totals back. Counts of all training texts, one exchange.
2. Baum-Welch: each round, tasks take the expected counts of states, of moves
   between them and of what they emit from their blocks; the counts are added
   up by class, and the driver holds the sums, whose size the model fixes. They
   are whole numbers (of ``UNIT``), so that no order of adding changes a bit.
3. The scaled forward recursion gives a text's likelihood over all paths.

Long texts are cut into pieces of ``PIECE`` tokens. What a piece does to any
state vector is a matrix; the product of the pieces' matrices gives the state
at the start and end of each, exactly, so all pieces run side by side.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_list, mix64, pack, quoted, rest_struct, stored, unpack
from .runs import _WORD
from .words import slices, word_hashes, words_of

STATES = 8
ROUNDS = 6
#: A word with one in so many training tokens, or more, is a class.
OWN = 4096
#: Classes by form, for all other words. Class 0 is the end of a text.
FORMS = 2048
#: Emissions start from so many tokens by the classes' shares.
PRIOR = 10.0
#: First guess: the chance to stay in a state, and how far emissions differ.
STAY, SPREAD = 0.8, 1.0
#: Tokens of a piece, and pieces that run side by side.
PIECE = 1024
ABREAST = 512
#: Products of emissions are scaled back after so many.
RESCALE = 8
#: Expected counts are added up in parts of one.
UNIT = 1 << 16
#: Text of a block, and words of a bucket.
BLOCK_BYTES = 4 << 20
BUCKET_WORDS = 400_000
_COUNT = [f"s{k}" for k in range(STATES)]
#: Keys of the sums beside classes: first states, moves (one row a state).
_FIRST, _MOVES = -1, -2


def not_trained(doc_id: Column) -> Column:
    """Is a document kept from training: crc32 of its id as text, mod 7, is 2.
    A NULL id is not held out, but is not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def forms(buf: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A class of words by length, first byte and the last two."""
    size = stops - starts
    key = np.minimum(size, 12).astype(np.uint64)
    for at in (starts, stops - 1, np.maximum(stops - 2, starts)):
        key = key << np.uint64(8) | buf[at].astype(np.uint64)
    return (mix64(key * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(FORMS)).astype(np.uint16)


def read_blocks(block_bytes: int):
    """Rows to blocks: the rows, their tokens as numbers of the block's words,
    and the words (by hash) with their form and count in training texts."""

    def run(batches):
        at = 0
        for batch in batches:
            texts = binary_list(pa.chunked_array([batch["text"]]))
            train = np.array(batch["train"].to_pylist(), dtype=bool)
            for a, b in slices(texts, block_bytes):
                buf, starts, stops, doc = words_of(texts[a:b], _WORD)
                words, first, number = np.unique(word_hashes(buf, starts, stops), return_index=True, return_inverse=True)
                count = np.bincount(number[train[a:b][doc]], minlength=len(words)).astype(np.uint32)
                sizes = np.bincount(doc, minlength=b - a)
                rows = pa.StructArray.from_arrays([batch["id"][a:b], batch["held_out"][a:b], batch["rest"][a:b]], names=["id", "held_out", "rest"])
                learned = int((sizes[train[a:b]] + 1).sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([(batch["part"][0].as_py() << 32) + at], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), rows),
                        pa.array([pack(sizes.astype(np.int32), train[a:b].view(np.uint8), number.astype(np.uint32))], pa.binary()),
                        pa.array([pack(words, forms(buf, starts[first], stops[first]), count)], pa.binary()),
                        pa.array([len(words)], pa.int64()),
                        pa.array([learned], pa.int64()),
                        pa.array([int(train[a:b].sum())], pa.int64()),
                    ],
                    names=["block", "rows", "tokens", "words", "n_words", "learned", "ends"],
                )
                at += 1

    return run


def send_words(buckets: int):
    def run(batches):
        for batch in batches:
            for block, value in zip(batch["block"].to_pylist(), batch["words"].to_pylist(), strict=True):
                words, form, count = unpack(value)
                if not len(words):
                    continue
                # buckets are ranges of hashes, and words are in their order
                to = ((words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(to, prepend=-1))
                ends = np.append(cuts[1:], len(to))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[cuts]), pa.array([block] * len(cuts), pa.int64()), pa.array([pack(words[a:b], form[a:b], count[a:b]) for a, b in zip(cuts, ends, strict=True)], pa.binary())],
                    names=["bucket", "block", "words"],
                )

    return run


#: Rows of ``add_up``: totals for a block, and sums by form, and own words.
_TOTALS, _FORM, _OWN = 0, 1, 2
_SUMS = "kind int, block long, bucket long, totals binary, key long, tokens long, words long"


def add_up(learned: int):
    """One bucket: the total count of each word to every block that has it, the
    tokens and words of each form, and the words that are classes."""

    def run(group: pa.Table) -> pa.Table:
        sent = [unpack(x) for x in group["words"].to_pylist()]
        blocks = group["block"].to_pylist()
        words, first, at = np.unique(np.concatenate([x[0] for x in sent]), return_index=True, return_inverse=True)
        form = np.concatenate([x[1] for x in sent])[first]
        total = np.zeros(len(words), dtype=np.int64)
        np.add.at(total, at, np.concatenate([x[2] for x in sent]).astype(np.int64))
        replies = np.split(total[at], np.cumsum([len(x[0]) for x in sent])[:-1])
        own = (total > 0) & (total * OWN >= learned)
        rest = ~own & (total > 0)
        tokens = np.bincount(form[rest], weights=total[rest], minlength=FORMS).astype(np.int64)
        kinds = np.bincount(form[rest], minlength=FORMS).astype(np.int64)
        held = np.flatnonzero(kinds)
        n, m, k = len(sent), len(held), int(own.sum())
        bucket = group["bucket"][0].as_py()
        return pa.table(
            {
                "kind": pa.array([_TOTALS] * n + [_FORM] * m + [_OWN] * k, pa.int32()),
                "block": pa.array(blocks + [None] * (m + k), pa.int64()),
                "bucket": pa.array([bucket] * (n + m + k), pa.int64()),
                "totals": pa.array([pack(r) for r in replies] + [None] * (m + k), pa.binary()),
                "key": pa.array([None] * n + held.tolist() + words[own].view(np.int64).tolist(), pa.int64()),
                "tokens": pa.array([None] * n + tokens[held].tolist() + total[own].tolist(), pa.int64()),
                "words": pa.array([None] * n + kinds[held].tolist() + [1] * k, pa.int64()),
            }
        )

    return run


class Lexicon:
    """Counts of the training tokens, and the classes."""

    def __init__(self, learned: int, ends: int, form_rows, own_rows):
        self.learned = learned
        self.form_tokens, self.form_words = np.zeros(FORMS, dtype=np.int64), np.zeros(FORMS, dtype=np.int64)
        for key, tokens, words in form_rows:
            self.form_tokens[key], self.form_words[key] = tokens, words
        own = sorted((np.uint64(key & (2**64 - 1)), tokens) for key, tokens in own_rows)
        self.own = np.array([x for x, _ in own], dtype=np.uint64)
        self.tokens = np.concatenate(([ends], self.form_tokens, np.array([t for _, t in own], dtype=np.int64)))
        self.distinct = int(self.form_words.sum()) + len(own) + (ends > 0)
        self.classes = len(self.tokens)
        #: log10 of one token's share, by its class
        self.share = -np.log10(self.form_tokens + self.form_words + 1.0)
        self.nothing = np.log10(learned + self.distinct + 1.0)

    def look_up(self, words: np.ndarray, form: np.ndarray, total: np.ndarray):
        """Class of each word, and log10 of its share of the class."""
        at = np.minimum(np.searchsorted(self.own, words), max(len(self.own) - 1, 0))
        own = self.own[at] == words if len(self.own) else np.zeros(len(words), dtype=bool)
        return np.where(own, 1 + FORMS + at, 1 + form.astype(np.int64)).astype(np.uint16), np.where(own, 0.0, np.log10(total + 1.0) + self.share[form])


def number_tokens(lexicon: Lexicon):
    """A block with the totals of its words: each text's classes (the end
    last), and its sums of what needs no state."""

    def run(block: pa.Table, totals: pa.Table) -> pa.Table:
        words, form, _ = unpack(block["words"][0].as_py())
        sizes, train, number = unpack(block["tokens"][0].as_py())
        order = np.argsort(np.array(totals["bucket"].to_pylist(), dtype=np.int64))
        parts = totals["totals"].to_pylist()
        total = np.concatenate([unpack(parts[i])[0] for i in order]) if len(words) else np.zeros(0, dtype=np.int64)
        kind, share = lexicon.look_up(words, form, total)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        ends = int(lexicon.tokens[0])
        by_text = lambda x: np.bincount(doc, weights=x[number], minlength=len(sizes))
        base = by_text(np.log10(total + 1.0)) + np.log10(ends + 1.0) - (sizes + 1) * lexicon.nothing
        known = by_text((total > 0).astype(float)).astype(np.int64) + (ends > 0)
        classes = np.zeros(len(number) + len(sizes), dtype=np.uint16)
        classes[np.arange(len(number)) + doc] = kind[number]
        return pa.table(
            {
                "rows": block["rows"],
                "tokens": pa.array([pack(sizes + np.int32(1), train, classes)], pa.binary()),
                "sums": pa.array([pack(known, base, by_text(share))], pa.binary()),
            }
        )

    return run


class Model:
    """First states, moves and emissions (class by state)."""

    def __init__(self, first: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.first, self.move, self.emit = first, move, emit
        self.by_state = np.ascontiguousarray(emit.T)

    @staticmethod
    def guess(shares: np.ndarray, seed: int = 0) -> Model:
        draw = np.random.default_rng(seed)
        emit = shares[:, None] * np.exp(SPREAD * draw.standard_normal((len(shares), STATES)))
        move = np.full((STATES, STATES), (1 - STAY) / (STATES - 1)) + np.eye(STATES) * (STAY - (1 - STAY) / (STATES - 1))
        return Model(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))

    @staticmethod
    def fit(shares: np.ndarray, first: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Model:
        first, move, emit = first + 1.0, move + 1.0, emit + PRIOR * shares[:, None]
        return Model(first / first.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


class Pieces:
    """Texts cut into pieces (all but a text's last of ``PIECE`` tokens), and
    what runs over them."""

    def __init__(self, sizes: np.ndarray, classes: np.ndarray):
        count = -(-sizes // PIECE)
        self.text = np.repeat(np.arange(len(sizes)), count)
        last = np.cumsum(count)
        within = np.arange(len(self.text)) - (last - count)[self.text]
        self.start = (np.cumsum(sizes) - sizes)[self.text] + within * PIECE
        self.size = np.minimum(PIECE, sizes[self.text] - within * PIECE)
        self.opens, self.closes = within == 0, within == count[self.text] - 1
        self.several = count[self.text] > 1
        self.count = count
        self.classes = classes

    def batches(self, which: np.ndarray):
        """Groups of pieces, longest first, with the number that still run at
        each place."""
        which = which[np.argsort(-self.size[which], kind="stable")]
        for a in range(0, len(which), ABREAST):
            at = which[a : a + ABREAST]
            yield at, np.searchsorted(-self.size[at], -np.arange(self.size[at[0]]), side="left")

    def laid_out(self, model: Model, at: np.ndarray, running: np.ndarray):
        """Tokens of a group of pieces by place, then piece: their classes,
        their emissions (a row for each state), and where each place begins."""
        place = np.concatenate(([0], np.cumsum(running)))
        t = np.repeat(np.arange(len(running)), running)
        kinds = self.classes[self.start[at[np.arange(place[-1]) - place[t]]] + t]
        return kinds, model.by_state.take(kinds, axis=1), place.tolist()

    def edges(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """The state before each piece (a distribution), and what follows it
        (up to a factor). A long text's first piece takes one vector to its
        end, its last piece one back to its start, a piece between them a
        matrix."""
        before, after = np.tile(model.first, (len(self.text), 1)), np.ones((len(self.text), STATES))
        ahead, back, between = {}, {}, {}
        for at, _ in self.batches(np.flatnonzero(self.several & ~self.closes)):
            # rows: each state the piece can start from, or the one first vector
            for ours, start, out in ((self.opens[at], model.first[None, :], ahead), (~self.opens[at], model.move, between)):
                on = at[ours]
                if len(on):
                    x = np.broadcast_to(start, (len(on), *start.shape)) * model.emit[self.classes[self.start[on]]][:, None, :]
                    for t in range(1, PIECE):
                        x = (x.reshape(-1, STATES) @ model.move).reshape(x.shape) * model.emit[self.classes[self.start[on] + t]][:, None, :]
                        if t % RESCALE == 0:
                            x /= x.max(axis=(1, 2), keepdims=True)
                    out.update(zip(on.tolist(), x / x.max(axis=(1, 2), keepdims=True), strict=True))
        for at, running in self.batches(np.flatnonzero(self.several & self.closes)):
            x = np.ones((len(at), STATES))
            for t in range(len(running) - 1, -1, -1):
                n = running[t]
                now = (x[:n] * model.emit[self.classes[self.start[at[:n]] + t]]) @ model.move.T
                x[:n] = now / now.max(axis=1, keepdims=True) if t % RESCALE == 0 else now
            back.update(zip(at.tolist(), x, strict=True))
        ends = np.cumsum(self.count)
        for k in np.flatnonzero(self.count > 1).tolist():
            a, b = int(ends[k] - self.count[k]), int(ends[k])
            for i in range(a, b - 1):
                x = before[i] @ between[i] if i > a else ahead[i][0]
                before[i + 1] = x / x.sum()
            for i in range(b - 2, a - 1, -1):
                x = between[i + 1] @ after[i + 1] if i < b - 2 else back[i + 1]
                after[i] = x / x.max()
        return before, after

    def forward(self, model: Model, at: np.ndarray, emits: np.ndarray, place: list[int], before: np.ndarray):
        """Scaled forward vectors, and the scale of each token."""
        state, scale, move = np.empty_like(emits), np.empty(emits.shape[1]), np.ascontiguousarray(model.move.T)
        x = np.where(self.opens[at][:, None], before[at], before[at] @ model.move).T
        for t, (a, b) in enumerate(zip(place, place[1:], strict=False)):
            if t:
                x = move @ x[:, : b - a]
            x = np.multiply(x, emits[:, a:b], out=state[:, a:b])
            x /= np.sum(x, axis=0, out=scale[a:b])
        return state, scale

    def likelihoods(self, model: Model) -> np.ndarray:
        """log10 of each text's likelihood, summed over all paths."""
        before, _ = self.edges(model)
        out = np.zeros(len(self.count))
        for at, running in self.batches(np.arange(len(self.text))):
            _, emits, place = self.laid_out(model, at, running)
            _, scale = self.forward(model, at, emits, place, before)
            piece = np.arange(place[-1]) - np.repeat(place[:-1], running)
            np.add.at(out, self.text[at], np.bincount(piece, weights=np.log10(scale), minlength=len(at)))
        return out

    def expected(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected first states, moves and emissions, and the log10 likelihood
        of all texts."""
        before, after = self.edges(model)
        first, moves, emitted, total = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros(model.by_state.shape), 0.0
        for at, running in self.batches(np.arange(len(self.text))):
            kinds, emits, place = self.laid_out(model, at, running)
            state, scale = self.forward(model, at, emits, place, before)
            total += float(np.log10(scale).sum())
            # what follows, scaled so that forward times backward is 1 at each place
            final = state[:, np.array(place)[self.size[at] - 1] + np.arange(len(at))]
            back = after[at].T / (final * after[at].T).sum(axis=0)
            emits /= scale
            for t in range(len(running) - 1, -1, -1):
                a, b = place[t], place[t + 1]
                n = b - a
                w = np.multiply(back[:, :n], emits[:, a:b])
                state[:, a:b] *= back[:, :n]
                if t:
                    c = place[t - 1]
                    moves += state[:, c : c + n] @ w.T  # still without what follows
                    np.matmul(model.move, w, out=back[:, :n])
                else:
                    on = ~self.opens[at]
                    moves += before[at][on].T @ w[:, on].T
            first += state[:, : len(at)][:, self.opens[at]].sum(axis=1)
            for s in range(STATES):
                emitted[s] += np.bincount(kinds, weights=state[s], minlength=emitted.shape[1])
        return first, moves * model.move, emitted.T, total


def expectations(model: Model):
    """A task's expected counts, in whole units, by class and state."""

    def run(batches):
        first, moves, emits = np.zeros(STATES, np.int64), np.zeros((STATES, STATES), np.int64), np.zeros(model.emit.shape, np.int64)
        for batch in batches:
            for value in batch["tokens"].to_pylist():
                sizes, train, classes = unpack(value)
                ours = train.astype(bool)
                if not ours.any():
                    continue
                found = Pieces(sizes[ours].astype(np.int64), classes[np.repeat(ours, sizes)]).expected(model)
                for total, part in zip((first, moves, emits), found[:3], strict=True):
                    total += np.rint(part * UNIT).astype(np.int64)
        held = np.flatnonzero(emits.any(axis=1))
        keys = np.concatenate((held, [_FIRST], _MOVES - np.arange(STATES)))
        rows = np.concatenate((emits[held], first[None, :], moves))
        yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(rows[:, s]) for s in range(STATES))], names=["key", *_COUNT])

    return run


def train(sequences: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all training texts."""
    shares = (lexicon.tokens + 1.0) / (lexicon.tokens + 1.0).sum()
    model = Model.guess(shares)
    for _ in range(rounds):
        rows = (
            sequences.select("tokens")
            .mapInArrow(expectations(model), "key long, " + ", ".join(f"{c} long" for c in _COUNT))
            .groupBy("key")
            .agg(*[F.sum(c).alias(c) for c in _COUNT])
            .collect()
        )
        counts = {r["key"]: np.array([r[c] for c in _COUNT]) / UNIT for r in rows}
        none = np.zeros(STATES)
        emit = np.stack([counts.get(k, none) for k in range(lexicon.classes)])
        moves = np.stack([counts.get(_MOVES - s, none) for s in range(STATES)])
        model = Model.fit(shares, counts.get(_FIRST, none), moves, emit)
    return model


def score_rows(model: Model, learned: int):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                rows = batch["rows"][k].values
                sizes, _, classes = unpack(batch["tokens"][k].as_py())
                known, base, share = unpack(batch["sums"][k].as_py())
                sizes = sizes.astype(np.int64)
                score = Pieces(sizes, classes).likelihoods(model) + share
                yield pa.RecordBatch.from_arrays(
                    [rows.field("id"), rows.field("held_out"), pa.array(sizes), pa.array(known), pa.array([learned] * len(sizes), pa.int64()), pa.array(base), pa.array(score), rows.field("rest")],
                    names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "rest"],
                )

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None, rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each whole text's log10 probability under a hidden Markov model trained
    on the texts that are not ``held_out`` (by default: ``not_trained``).

    Returns ``id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known``
    (tokens that training texts hold), ``train_tokens``, ``base_score`` (log10
    probability by single tokens, each counted once more than seen), ``score``
    and ``rest`` (a struct of all other columns, whatever their names), a row
    for each input row.

    Words are compared by 64-bit hash, A-Z lower-cased. A NULL or empty text is
    its end alone. Repeated rows are learned from and scored one by one; a NULL
    id isn't held out, nor learned from. A very long text is cut into pieces
    whose results are put together exactly; its tokens take a few bytes each. Without training texts every token is unseen,
    ``base_score`` is 0 and the model its first guess. An empty table gives an
    empty result. Reruns over the same files agree.

    The texts' jobs run when this is called: one pass to read them, one
    exchange of words, and a pass over the numbered tokens each round.
    """
    key = quoted(id_col)
    held = not_trained(key) if held_out is None else F.coalesce(held_out, F.lit(False))
    rows = docs.select(
        key.alias("id"),
        quoted(text_col).alias("text"),
        held.alias("held_out"),
        (~held & key.isNotNull()).alias("train"),
        F.spark_partition_id().cast("long").alias("part"),
        rest_struct(docs, id_col, text_col).alias("rest"),
    )
    row = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in ("id", "held_out", "rest")])
    schema = T.StructType().add("block", T.LongType()).add("rows", T.ArrayType(row)).add("tokens", T.BinaryType()).add("words", T.BinaryType())
    for c in ("n_words", "learned", "ends"):
        schema = schema.add(c, T.LongType())
    blocks = stored(rows.mapInArrow(read_blocks(block_bytes), schema), "lm-blocks")
    words, learned, ends = (x or 0 for x in blocks.agg(F.sum("n_words"), F.sum("learned"), F.sum("ends")).first())
    buckets = max(1, -(-words // BUCKET_WORDS))
    sums = stored(
        blocks.select("block", "words").mapInArrow(send_words(buckets), "bucket long, block long, words binary").groupBy("bucket").applyInArrow(add_up(learned), _SUMS),
        "lm-words",
    )
    # at most FORMS rows, and OWN
    by_form = sums.where(F.col("kind") == _FORM).groupBy("key").agg(F.sum("tokens"), F.sum("words")).collect()
    own = sums.where(F.col("kind") == _OWN).select("key", "tokens").collect()
    lexicon = Lexicon(learned, ends, by_form, own)
    totals = sums.where(F.col("kind") == _TOTALS).select("block", "bucket", "totals")
    numbered = T.StructType().add("rows", T.ArrayType(row)).add("tokens", T.BinaryType()).add("sums", T.BinaryType())
    sequences = stored(
        blocks.select("block", "rows", "tokens", "words").groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(number_tokens(lexicon), numbered), "lm-sequences"
    )
    model = train(sequences, lexicon, rounds)
    out = T.StructType([row["id"], row["held_out"]])
    for c, kind in {"n_tokens": T.LongType(), "n_known": T.LongType(), "train_tokens": T.LongType(), "base_score": T.DoubleType(), "score": T.DoubleType()}.items():
        out = out.add(c, kind)
    return sequences.mapInArrow(score_rows(model, learned), out.add(row["rest"]))
