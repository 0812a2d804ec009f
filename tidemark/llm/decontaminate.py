"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, and
exact similarity of weighted shingles.

The benchmark is the stated query set. It is taken in blocks of bounded size; each block is
sent to the executors and looked up in one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.bytewords import U, mix, shingles_of, text_slices, words_of
from tidemark.llm.store import free_name, map_arrow

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19  # bits of 64; texts at similarity 0.8 differ in 10 bits, give or take 3
BLOCKS = 4  # of 16 bits: within RADIUS, some block differs in at most RADIUS // BLOCKS bits
BLOCK_ITEMS, BLOCK_BYTES = 1024, 8 << 20
FILTER_BITS = 22
CHUNK = 4096  # window starts fingerprinted at once, 1 KB each
LEAKS = "array<struct<item_id:{},similarity:double,first_word:int,n_words:int>>"  # by the type of the item's id
POPCOUNT = np.array([bin(i).count("1") for i in range(1 << 16)], dtype=np.uint8)
BIT = np.arange(64, dtype=U)


def signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 by bit of each shingle."""
    return (((mix(hashes)[:, None] >> BIT) & U(1)).astype(np.int32) << 1) - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(U) << BIT).sum(axis=1, dtype=U)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a ^ b
    return sum(POPCOUNT[((x >> U(16 * j)) & U(0xFFFF)).astype(np.int64)].astype(np.int64) for j in range(4))


class ItemIndex:
    """Items of one block: their shingles, fingerprints and the multi-index over these."""

    def __init__(self, ids: list[int], texts: list[str]) -> None:
        self.ids, self.counts, self.sizes, self.ks = [], [], [], []
        prints, keys, owners = [], [], []
        for item_id, text in zip(ids, texts):
            for _, data, offsets in text_slices(pa.array([text or ""])):
                words = words_of(data, offsets)
                n = len(words.doc)
                if not n:
                    continue
                k = min(SHINGLE, n)
                hashes = shingles_of(words, k).hash
                values, times = np.unique(hashes, return_counts=True)
                owners.append(np.full(len(values), len(self.ids)))
                keys.append(values)
                prints.append(fingerprints(signs(hashes).sum(axis=0)[None, :])[0])
                self.ids.append(item_id)
                self.counts.append((values, times))
                self.sizes.append(len(hashes))
                self.ks.append(k)
        keys = np.concatenate(keys) if keys else np.zeros(0, U)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], (np.concatenate(owners) if owners else np.zeros(0, np.int64))[order]
        self.seen = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.seen[(self.keys >> U(64 - FILTER_BITS)).astype(np.int64)] = True
        self.prints = np.array(prints, dtype=U)
        self.sizes, self.ks = np.array(self.sizes, dtype=np.int64), np.array(self.ks, dtype=np.int64)
        # Per block and its value: the items near it, as packed bits.
        values = np.arange(1 << 16, dtype=np.int64)
        self.near = []
        for j in range(BLOCKS):
            own = ((self.prints >> U(16 * j)) & U(0xFFFF)).astype(np.int64)
            self.near.append(np.packbits(POPCOUNT[values[:, None] ^ own[None, :]] <= RADIUS // BLOCKS, axis=1))

    def candidates(self, prints: np.ndarray) -> np.ndarray:
        """Boolean (windows, items): within RADIUS. None is missed: of the blocks of two
        fingerprints within RADIUS, one is within RADIUS // BLOCKS."""
        bits = np.zeros((len(prints), self.near[0].shape[1]), dtype=np.uint8)
        for j, table in enumerate(self.near):
            bits |= table[((prints >> U(16 * j)) & U(0xFFFF)).astype(np.int64)]
        found = np.unpackbits(bits, axis=1, count=len(self.prints)).astype(bool)
        w, i = np.nonzero(found)
        found[w, i] = distance(prints[w], self.prints[i]) <= RADIUS
        return found

    def leaks_in(self, hashes: np.ndarray, k: int, hits: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """Best (similarity, first word, words) by item, in a text given by its shingles.
        ``hits``: the shingles that some item has. A window without one is similar to none,
        so only windows over hits are fingerprinted."""
        best: dict[int, tuple[float, int, int]] = {}
        n = len(hashes)
        # The range of equal keys is walked, as items share shingles.
        low, high = np.searchsorted(self.keys, hashes[hits]), np.searchsorted(self.keys, hashes[hits], side="right")
        sizes: dict[int, list[int]] = {}
        for p, a, b in zip(hits, low, high):
            for m in {int(x) for x in self.sizes[self.owners[a:b]][self.ks[self.owners[a:b]] == k]}:
                sizes.setdefault(m, []).append(int(p))
        for m, places in sizes.items():
            width = min(m, n)
            cover = np.zeros(n - width + 2, dtype=np.int64)
            at = np.array(places)
            np.add.at(cover, np.clip(at - width + 1, 0, n - width), 1)
            np.add.at(cover, np.minimum(at, n - width) + 1, -1)
            starts = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
            # A part spans as many shingles at most, and a window, however far apart its hits are.
            for part in np.split(starts, np.flatnonzero(np.diff(starts // CHUNK)) + 1):
                lo, hi = int(part[0]), int(part[-1]) + width
                sums = np.zeros((hi - lo + 1, 64), dtype=np.int32)
                np.cumsum(signs(hashes[lo:hi]), axis=0, out=sums[1:])
                prints = fingerprints(sums[part - lo + width] - sums[part - lo])
                found = self.candidates(prints) & ((self.sizes == m) & (self.ks == k))[None, :]
                for w, item in zip(*np.nonzero(found)):
                    s = int(part[w])
                    similarity = self.similarity(hashes[s : s + width], int(item))
                    if similarity >= SIMILARITY and similarity > best.get(item, (0.0,))[0]:
                        best[int(item)] = (similarity, s, width + k - 1)
        return best

    def similarity(self, hashes: np.ndarray, item: int) -> float:
        """Sum of the lesser over sum of the greater weights; a weight is how often a shingle
        occurs."""
        values, times = np.unique(hashes, return_counts=True)
        own, weights = self.counts[item]
        _, a, b = np.intersect1d(values, own, assume_unique=True, return_indices=True)
        common = int(np.minimum(times[a], weights[b]).sum())
        return common / (int(times.sum()) + int(weights.sum()) - common)


def item_blocks(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[ItemIndex]:
    ids, texts, size = [], [], 0
    for row in benchmark.select(id_column, text_column).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1] or "")
        if len(ids) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield ItemIndex(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield ItemIndex(ids, texts)


def with_leaks(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_id: str = "item_id", item_text: str = "text", name: str = "__leaks") -> DataFrame:
    """The columns of ``docs`` and ``name``, which must not be one of them: per benchmark item of which some window of the
    item's size is similar (0.8 or more on five-word shingles, A-Z lower-cased), the item, the
    best similarity and its place in words.

    Items with fewer than five words are one shingle of all their words; a text shorter than
    an item is one window. Null or empty texts and items match nothing. Repeated rows are
    treated alike; repeated items are all reported; item ids may be of any type. An empty benchmark gives empty lists.
    """
    if free_name(docs, name) != name:
        raise ValueError(f"the documents have a column {name!r}")
    out = docs.withColumn(name, F.array().cast(LEAKS.format(benchmark.schema[item_id].dataType.simpleString())))
    position, place = docs.columns.index(text_column), len(docs.columns)
    for index in item_blocks(benchmark, item_id, item_text):
        if len(index.ids):
            out = _one_block(out, index, position, place)
    return out


def _one_block(docs: DataFrame, index: ItemIndex, position: int, place: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)
    schema = T.StructType(docs.schema.fields)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: ItemIndex = shared.value
        for batch in batches:
            leaks = batch.column(place).to_pylist()
            for row, data, offsets in text_slices(batch.column(position)):
                words = words_of(data, offsets)
                for k in np.unique(items.ks):
                    shingles = shingles_of(words, int(k))
                    maybe = np.flatnonzero(items.seen[(shingles.hash >> U(64 - FILTER_BITS)).astype(np.int64)])
                    at = np.searchsorted(items.keys, shingles.hash[maybe])
                    maybe = maybe[items.keys[np.minimum(at, len(items.keys) - 1)] == shingles.hash[maybe]]
                    for doc in np.unique(shingles.doc[maybe]):
                        lo, hi = np.searchsorted(shingles.doc, [doc, doc + 1])
                        own = maybe[(maybe >= lo) & (maybe < hi)] - lo
                        best = items.leaks_in(shingles.hash[lo:hi], int(k), own)
                        leaks[row + doc] = (leaks[row + doc] or []) + [
                            {"item_id": items.ids[i], "similarity": v[0], "first_word": v[1], "n_words": v[2]} for i, v in sorted(best.items())]
            columns = [pa.array(leaks, batch.schema.field(place).type) if i == place else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_arrow(docs, found, schema)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it: ``doc_id``, ``item_id``,
    ``similarity``, ``first_word``, ``n_words``. Clean documents have no row."""
    return with_leaks(docs.select("doc_id", "text"), benchmark).select("doc_id", F.inline("__leaks"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found, with all their columns, whatever
    their names."""
    name = free_name(docs, "__leaks")
    return with_leaks(docs, benchmark, name=name).where(F.size(name) == 0).drop(name)
