"""Token counts by section, with offsets.

A document is encoded once, whole. Its tokens' byte ranges are then joined with
the ranges of its sections, and each token goes where a rule says:

- ``start``: to the section that holds its first byte;
- ``majority``: to the section that holds most of its bytes, the first of equals;
- ``proportional``: to every section it touches, by share of bytes.

Byte-level vocabularies lose nothing, so a token's length in bytes follows from
its id, and ranges are exact even where a token ends inside a character.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_list, quoted, rest_struct

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that cuts text into words for this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("start", "majority", "proportional")

_SECTIONS = pa.list_(pa.struct([("name", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("tokens", pa.float64())]))


def encoder(vocabulary: str):
    """The encoding in a rank file, and the bytes of each token id."""
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    return tiktoken.Encoding("from-file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), size


def lines(text: bytes) -> list[tuple[str, int, int]]:
    """Byte ranges of the lines, each with its line feed."""
    feeds = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    cuts = np.unique(np.concatenate(([0], feeds, [len(text)])))
    return [(str(i), int(a), int(b)) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]


def char_starts(text: bytes) -> np.ndarray:
    """Byte places of the characters, and the end."""
    b = np.frombuffer(text, np.uint8)
    return np.append(np.flatnonzero((b & 0xC0) != 0x80), len(b))


def attribute(ends: np.ndarray, sections: list[tuple[int, int]], rule: str) -> tuple[np.ndarray, int]:
    """Tokens of each section (disjoint byte ranges in order), and how many
    tokens don't lie in one section or gap as a whole. ``ends``: the tokens'."""
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(ends) else ends
    # all cuts: sections and the gaps between them are segments
    cuts = np.array([x for s in sections for x in s], dtype=np.int64)
    head, tail = (np.searchsorted(cuts, x, side="right") - 1 for x in (starts, ends - 1))
    whole = head == tail
    out = np.zeros(len(sections))

    def give(segment: np.ndarray, amount: np.ndarray | float) -> None:
        # an even cut opens a section, an odd one a gap
        on = (segment >= 0) & (segment % 2 == 0)
        np.add.at(out, segment[on] // 2, amount[on] if isinstance(amount, np.ndarray) else amount)

    give(head[whole] if rule != "start" else head, 1.0)
    if rule != "start":
        for t in np.flatnonzero(~whole).tolist():
            a, b = int(starts[t]), int(ends[t])
            segment = np.arange(head[t], tail[t] + 1)
            low = np.maximum(a, np.where(segment >= 0, cuts[segment], a))
            high = np.minimum(b, np.append(cuts[segment[1:]], b))
            share = (high - low) / (b - a)
            if rule == "proportional":
                give(segment, share)
            else:
                give(segment[[int(share.argmax())]], 1.0)
    # an empty section between equal cuts is no boundary
    crossing = sum(1 for t in np.flatnonzero(~whole).tolist() if len(np.unique(np.clip(cuts[head[t] + 1 : tail[t] + 1], starts[t] + 1, ends[t] - 1))) > 0)
    return out, crossing


def count_rows(vocabulary: str, rule: str, given: bool):
    def run(batches):
        encoding, size = encoder(vocabulary)
        for batch in batches:
            texts = binary_list(pa.chunked_array([batch["text"]]))
            ranges = batch["sections"].to_pylist() if given else [None] * len(texts)
            totals, crossings, found, outside = [], [], [], []
            for text, spans in zip(texts, ranges, strict=True):
                ids = np.array(encoding.encode_ordinary(text.decode("utf-8", "replace")), dtype=np.int64)
                ends = np.cumsum(size[ids])
                if given:
                    at = char_starts(text)
                    cut = lambda x, at=at: int(at[min(max(x, 0), len(at) - 1)])
                    parts = [(s["name"], cut(s["start"]), cut(s["end"])) for s in spans or [] if s is not None]
                    parts = [(n, a, max(a, b)) for n, a, b in sorted(parts, key=lambda p: p[1:])]
                    if any(p[2] > q[1] for p, q in zip(parts, parts[1:], strict=False)):
                        raise ValueError("sections overlap")
                else:
                    parts = lines(text)
                counts, crossing = attribute(ends, [(a, b) for _, a, b in parts], rule)
                totals.append(len(ids))
                crossings.append(crossing)
                outside.append(float(len(ids) - counts.sum()))
                found.append([{"name": n, "start": a, "end": b, "tokens": float(c)} for (n, a, b), c in zip(parts, counts, strict=True)])
            columns = [batch["id"], batch["rest"], pa.array(list(map(len, texts)), pa.int64()), pa.array(totals, pa.int64()), pa.array(crossings, pa.int64()), pa.array(outside, pa.float64()), pa.array(found, _SECTIONS)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "rest", "n_bytes", "n_tokens", "n_crossing", "outside", "sections"])

    return run


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sections: Column | None = None, rule: str = "start", vocabulary: str = VOCABULARY) -> DataFrame:
    """Tokens of each whole text, by section.

    ``sections``: array of structs ``name``, ``start``, ``end`` (characters from
    0, end not included, disjoint); by default the text's lines, each with its
    line feed, numbered from 0. Returns ``id``, ``rest`` (a struct of the other
    columns), ``n_bytes``, ``n_tokens``, ``n_crossing`` (tokens that a section's
    edge cuts), ``outside`` (tokens that go to no section) and ``sections``
    (array of name, start, end in bytes, and tokens), a row for each input row.
    Section tokens and ``outside`` add up to ``n_tokens``.

    A NULL or empty text has no tokens and no lines. NULL sections are none;
    ranges beyond the text are cut to it; overlapping ones are an error.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    rows = docs.select(
        quoted(id_col).alias("id"),
        quoted(text_col).alias("text"),
        rest_struct(docs, id_col, text_col).alias("rest"),
        *([sections.alias("sections")] if sections is not None else []),
    )
    schema = T.StructType([rows.schema["id"], rows.schema["rest"]])
    for c in ("n_bytes", "n_tokens", "n_crossing"):
        schema = schema.add(c, T.LongType())
    schema = schema.add("outside", T.DoubleType()).add("sections", T.DataType.fromDDL("array<struct<name: string, start: long, end: long, tokens: double>>"))
    return rows.mapInArrow(count_rows(vocabulary, rule, sections is not None), schema)
