"""Counting keys over all documents without moving a row per key.

Documents are dealt into parts. Each part sends, per shard of the key space, its distinct
keys as one Elias-Fano block with their counts; the shard adds up the parts and answers each
with a block of codes in the order of its keys. So a key costs some bits on the way, and the
answer needs no keys at all. A frequent key is one entry per part.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.bytewords import U, mix
from tidemark.llm.eliasfano import EliasFano

ASKS = "level int, shard int, part int, keys binary, counts binary"
ASK_TYPES = pa.schema([("level", pa.int32()), ("shard", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def parts_of(docs: DataFrame) -> int:
    """As many parts and shards as the session has shuffle partitions."""
    return max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_part(docs: DataFrame, id_column: str, text_column: str, parts: int) -> DataFrame:
    return docs.withColumn("part", F.pmod(F.xxhash64(F.col(id_column), F.col(text_column)), F.lit(parts)).cast("int"))


def pack(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def unpack(block: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(block), dtype=dtype)


def shard_order(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by shard, and where each shard begins in it."""
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def asks(part: int, level: int, keys: np.ndarray, counts: np.ndarray, shard: np.ndarray, shards: int) -> list[tuple]:
    """Rows of ``ASKS`` for sorted distinct keys."""
    order, bounds = shard_order(shard, shards)
    rows = []
    for s in range(shards):
        own = order[bounds[s] : bounds[s + 1]]
        if len(own):
            rows.append((level, s, part, EliasFano.encode(keys[own]), pack(counts[own].astype(np.uint32))))
    return rows


def asks_table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(ASK_TYPES)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ASK_TYPES)], schema=ASK_TYPES)


def answers(codes: dict[int, np.ndarray], shard: np.ndarray, shards: int, n: int) -> np.ndarray:
    """The codes of sorted keys, put together from the shards' blocks."""
    order, bounds = shard_order(shard, shards)
    first = next(iter(codes.values())) if codes else np.zeros(0, np.int64)
    out = np.zeros(n, dtype=first.dtype)
    for s, block in codes.items():
        out[order[bounds[s] : bounds[s + 1]]] = block
    return out


def even_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys) % U(shards)).astype(np.int64)
