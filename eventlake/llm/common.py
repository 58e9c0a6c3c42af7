"""Helpers shared by the operators: stored intermediate tables, row keys,
and word tokenization as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir

#: Sorts after every document id; stands for a NULL id.
NO_ID = np.iinfo(np.int64).max


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: the
    lineage ends there, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, col: str) -> int:
    """Total UTF-8 bytes of a text column."""
    return df.agg(F.sum(F.octet_length(F.col(col)).cast("long"))).first()[0] or 0


def drawn(share: float, *columns: Column | str) -> Column:
    """Is a row in a sample of about this share, by a hash of the columns of
    63 bits: however large the table, the share isn't rounded to nothing."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 1) < F.lit(min(2**63 - 1, int(share * 2**63)))


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def rest_struct(df: DataFrame, *used: str) -> Column:
    """All columns but ``used`` as one struct, so that their names can't clash
    with an operator's own; a struct of one NULL where nothing is left."""
    others = [quoted(c).alias(c) for c in df.columns if c not in used]
    return F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))


def binary_list(column: pa.ChunkedArray) -> list[bytes]:
    """Values of a text or binary column as bytes; NULL becomes empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; lengths and types are kept."""
    parts = [np.array([len(arrays)], dtype="<i8").tobytes()]
    for a in arrays:
        kind = a.dtype.str.encode().ljust(8)
        parts += [kind, np.array([a.size], dtype="<i8").tobytes(), np.ascontiguousarray(a).tobytes()]
    raw = b"".join(parts)
    return np.array([len(raw)], dtype="<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(value: bytes) -> list[np.ndarray]:
    """The arrays of ``pack``, flat."""
    size = int(np.frombuffer(value, "<i8", 1)[0])
    raw = pa.decompress(value[8:], decompressed_size=size, codec="zstd", asbytes=True)
    count, at, out = int(np.frombuffer(raw, "<i8", 1)[0]), 8, []
    for _ in range(count):
        kind = np.dtype(raw[at : at + 8].strip().decode())
        n = int(np.frombuffer(raw, "<i8", 1, at + 8)[0])
        out.append(np.frombuffer(raw, kind, n, at + 16))
        at += 16 + n * kind.itemsize
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (in place)."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def joined(texts: list[bytes], pad: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts end to end as one byte array (plus ``pad`` zero bytes), with the
    start and end of each."""
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes)
    buf = np.frombuffer(b"".join(texts) + bytes(pad), dtype=np.uint8)
    return buf, ends - sizes, ends
