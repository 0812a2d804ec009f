"""Exact removal of repeated passages with suffix arrays.

A string of 200 bytes that also starts elsewhere is found in three rounds over the documents,
which are dealt into parts:

1. Each window of 200 bytes has an anchor: the 100 bytes in it with the least hash. Equal
   windows have equal anchors at the same place. Windows that follow one another and share an
   anchor form a segment. Counting anchors and segments (``exchange``) tells which anchors
   occur once (no window repeats), which only in equal segments (all windows repeat), and
   which in several different segments.
2. The different segments of an anchor of the last kind meet in a bucket. Its suffix array
   puts equal windows side by side. An anchor with more segments than ``BUCKET`` is in no
   bucket: its windows are counted one by one, by hash, over all shards, so no task gets all
   of them.
3. Each document removes the bytes under repeated windows.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.bytewords import U, mix, prefix_hash, range_hash, text_slices
from tidemark.llm.eliasfano import EliasFano
from tidemark.llm.exchange import answers, even_shard, pack, parts_of, shard_order, unpack, with_part
from tidemark.llm.store import ship, written
from tidemark.llm.suffixes import suffix_array

LENGTH, ANCHOR = 200, 100
BUCKET = 256
PLACE_BITS = 28
ONCE, SAME, SEVERAL, MANY = 0, 1, 2, 3

ASKS = "kind int, shard int, part int, keys binary, extra binary, body binary"
ASK_TYPES = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("extra", pa.binary()), ("body", pa.binary())])
REPLIES = "part int, kind int, shard int, codes binary"
REPLY_TYPES = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("shard", pa.int32()), ("codes", pa.binary())])


def _table(rows: list[tuple], types: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``, by running minima within blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=U)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchor_places(hashes: np.ndarray, block: int = 1 << 24) -> np.ndarray:
    """For each window the place of its least hash, by the upper bits, the first of equal ones.
    Blocks of windows overlap by one window, so places within a block fit ``PLACE_BITS``
    however long the text is."""
    width = LENGTH - ANCHOR + 1
    if block + width > 1 << PLACE_BITS:
        raise ValueError("places of a block do not fit")
    bits = U(PLACE_BITS)
    found = [np.zeros(0, np.int64)]
    for base in range(0, len(hashes) - width + 1, block):
        part = hashes[base : base + block + width - 1]
        order = (part >> bits << bits) | np.arange(len(part)).astype(U)
        least = least_in_windows(order, width)
        found.append((least & U((1 << PLACE_BITS) - 1)).astype(np.int64) + base)
    return np.concatenate(found)


class Slice:
    """Segments of the texts of one slice: anchor, name, first and last window."""

    def __init__(self, row: int, data: np.ndarray, offsets: np.ndarray) -> None:
        self.row, self.data, self.offsets = row, data, offsets
        n = len(data)
        none = np.zeros(0, np.int64)
        self.first = self.last = none
        self.anchor = self.name = np.zeros(0, U)
        if n < LENGTH:
            return
        self.sums = prefix_hash(data)
        starts = np.arange(n - ANCHOR + 1)
        hashes = range_hash(self.sums, starts, starts + ANCHOR)
        place = anchor_places(hashes)
        long = np.flatnonzero(np.diff(offsets) >= LENGTH)
        edge = np.zeros(n + 2, dtype=np.int32)
        np.add.at(edge, offsets[long], 1)
        np.add.at(edge, offsets[long + 1] - LENGTH + 1, -1)
        windows = np.flatnonzero(np.cumsum(edge)[: len(place)] > 0)
        if not len(windows):
            return
        at = place[windows]
        new = np.r_[True, (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)]
        begin = np.flatnonzero(new)
        self.first = windows[begin]
        self.last = windows[np.r_[begin[1:], len(windows)] - 1]
        anchors = at[begin]
        self.anchor = hashes[anchors]
        shape = ((anchors - self.first) * 1024 + (self.last - self.first)).astype(U)
        self.name = mix(range_hash(self.sums, self.first, self.last + LENGTH) ^ mix(shape))


class Part:
    """All slices of a part, and its distinct (anchor, segment) pairs in order of the anchor."""

    def __init__(self, texts: pa.Array) -> None:
        self.slices = [Slice(*s) for s in text_slices(texts)]
        anchor = np.concatenate([s.anchor for s in self.slices] or [np.zeros(0, U)])
        name = np.concatenate([s.name for s in self.slices] or [np.zeros(0, U)])
        order = np.lexsort((name, anchor))
        a, b = anchor[order], name[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
        self.anchor, self.name = a[new], b[new]
        index = np.cumsum(new) - 1
        self.index = np.zeros(len(order), dtype=np.int64)
        self.index[order] = index
        self.counts = np.bincount(index, minlength=len(self.anchor))
        self.example = order[np.flatnonzero(new)]  # a segment of each pair, counted over slices
        self.bounds = np.cumsum([0] + [len(s.anchor) for s in self.slices])

    def codes(self, told: dict[int, np.ndarray], parts: int) -> np.ndarray:
        if not len(self.anchor):
            return np.zeros(0, np.uint8)
        return answers(told, even_shard(self.anchor, parts), parts, len(self.anchor))

    def several(self, codes: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
        """Per shard, the pairs that go to buckets, in order."""
        own = np.flatnonzero(codes == SEVERAL)
        order, bounds = shard_order(even_shard(self.anchor[own], parts), parts)
        return [(s, own[order[bounds[s] : bounds[s + 1]]]) for s in range(parts) if bounds[s] < bounds[s + 1]]

    def many(self, codes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Windows whose anchors have too many segments: their places by slice, the distinct
        hashes, and how often each occurs."""
        places, hashes = [], []
        for i, s in enumerate(self.slices):
            hot = np.flatnonzero(codes[self.index[self.bounds[i] : self.bounds[i + 1]]] == MANY)
            at = ranges(s.first[hot], s.last[hot] + 1)
            places.append(at)
            hashes.append(range_hash(s.sums, at, at + LENGTH) if len(at) else np.zeros(0, U))
        keys, counts = np.unique(np.concatenate(hashes or [np.zeros(0, U)]), return_counts=True)
        return places, keys, counts


def ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges [low, high), one after another."""
    sizes = high - low
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    out[0] = low[0]
    out[starts[1:]] = low[1:] - high[:-1] + 1
    return np.cumsum(out)


def _told(table: pa.Table) -> dict[int, dict[int, bytes]]:
    found: dict[int, dict[int, bytes]] = {}
    for kind, shard, codes in zip(table["kind"].to_pylist(), table["shard"].to_pylist(), table["codes"].to_pylist()):
        found.setdefault(kind, {})[shard] = codes
    return found


def _judge_anchors(key, table, bucket):
    """Code of every asked (anchor, segment): see ONCE to MANY."""
    shard = key[0].as_py()
    parts, names, anchors, counts = table["part"].to_pylist(), [], [], []
    for keys, extra, body in zip(table["keys"].to_pylist(), table["extra"].to_pylist(), table["body"].to_pylist()):
        anchors.append(EliasFano(keys).decode())
        names.append(np.frombuffer(extra, dtype=U))
        counts.append(unpack(body, np.uint32))
    sizes = [len(a) for a in anchors]
    anchor, name, count = np.concatenate(anchors), np.concatenate(names), np.concatenate(counts).astype(np.int64)
    order = np.lexsort((name, anchor))
    a, b = anchor[order], name[order]
    new_anchor = np.r_[True, a[1:] != a[:-1]]
    new_pair = new_anchor | np.r_[True, b[1:] != b[:-1]]
    of = np.cumsum(new_anchor) - 1
    total = np.bincount(of, weights=count[order]).astype(np.int64)
    different = np.bincount(of, weights=new_pair).astype(np.int64)
    code = np.where(total < 2, ONCE, np.where(different == 1, SAME, np.where(different <= bucket, SEVERAL, MANY))).astype(np.uint8)
    codes = np.zeros(len(anchor), np.uint8)
    codes[order] = code[of]
    cuts = np.cumsum([0] + sizes)
    return _table([(p, 1, shard, pack(codes[cuts[i] : cuts[i + 1]])) for i, p in enumerate(parts)], REPLY_TYPES)


def repeated_windows(segments: list[bytes]) -> list[np.ndarray]:
    """Per segment, which of its windows also start elsewhere in the segments, by one suffix
    array over all of them. The byte between segments occurs in no UTF-8 text."""
    text = b"\xff".join(segments)
    flags = np.zeros(len(text), dtype=bool)
    starts = np.cumsum([0] + [len(s) + 1 for s in segments])
    valid = np.zeros(len(text), dtype=bool)
    for s, segment in zip(starts, segments):
        valid[s : s + len(segment) - LENGTH + 1] = True
    data = np.frombuffer(text, dtype=np.uint8)
    order = np.array(suffix_array(text), dtype=np.int64)
    order = order[valid[order]]
    for i in range(0, len(order) - 1, 4096):
        here, after = order[i : i + 4096], order[i + 1 : i + 4097]
        here = here[: len(after)]
        span = np.arange(LENGTH)
        same = (data[here[:, None] + span] == data[after[:, None] + span]).all(axis=1)
        flags[here[same]] = True
        flags[after[same]] = True
    return [flags[s : s + len(g) - LENGTH + 1] for s, g in zip(starts, segments)]


def _judge_segments(key, table):
    """Flags of the windows of the asked segments (kind 2), or of the asked windows (3)."""
    kind, shard = key[0].as_py(), key[1].as_py()
    parts, keys = table["part"].to_pylist(), table["keys"].to_pylist()
    extras, bodies = table["extra"].to_pylist(), table["body"].to_pylist()
    rows = []
    if kind == 3:
        asked = [EliasFano(k).decode() for k in keys]
        values, inverse = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([unpack(b, np.uint32) for b in bodies]))
        for part, own in zip(parts, asked):
            rows.append((part, 3, shard, pack(total[np.searchsorted(values, own)] >= 2)))
        return _table(rows, REPLY_TYPES)
    bucket: dict[int, dict[int, list]] = {}
    asked = []
    for k, extra, body in zip(keys, extras, bodies):
        anchors, (names, counts, sizes) = EliasFano(k).decode().tolist(), np.frombuffer(extra, dtype=U).reshape(3, -1).tolist()
        body, at = zlib.decompress(body), 0
        for anchor, name, count, size in zip(anchors, names, counts, sizes):
            own = bucket.setdefault(anchor, {}).get(name)
            if own is None:
                bucket[anchor][name] = [count, body[at : at + size], None]
            else:
                own[0] += count
            at += size
        asked.append((anchors, names))
    for segments in bucket.values():
        entries = list(segments.values())
        for entry, flags in zip(entries, repeated_windows([e[1] for e in entries])):
            entry[2] = flags | (entry[0] > 1)
    for part, (anchors, names) in zip(parts, asked):
        flags = np.concatenate([bucket[a][b][2] for a, b in zip(anchors, names)])
        rows.append((part, 2, shard, pack(np.packbits(flags))))
    return _table(rows, REPLY_TYPES)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", parts: int | None = None, with_text: bool = False,
                   bucket: int = BUCKET) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256``, and the remaining bytes as ``kept`` (binary: a cut may fall inside a
    character) if asked for.

    A byte goes if a 200-byte string over it also starts anywhere else, in the same text or
    another; all occurrences go. Strings are judged on the input. Texts under 200 bytes, empty
    and null ones (empty) stay. Repeated rows are repeats of each other. A text may have up to
    256 MB. ``parts``: how many groups the documents are dealt into; one group is held in a
    task. ``bucket``: how many segments of an anchor share a suffix array at most. Empty input:
    no rows.
    """
    parts = parts or parts_of(docs)
    ship(docs.sparkSession)
    chosen = with_part(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), "doc_id", "text", parts)

    def ask_anchors(key, table):
        part, number = Part(table["text"].combine_chunks()), key[0].as_py()
        order, bounds = shard_order(even_shard(part.anchor, parts), parts)
        rows = []
        for s in range(parts):
            own = order[bounds[s] : bounds[s + 1]]
            if len(own):
                rows.append((1, s, number, EliasFano.encode(part.anchor[own]), part.name[own].tobytes(), pack(part.counts[own].astype(np.uint32))))
        return _table(rows, ASK_TYPES)

    def judge_anchors(key, table):
        return _judge_anchors(key, table, bucket)

    anchors = written(chosen.select("part", "text").groupBy("part").applyInArrow(ask_anchors, ASKS).groupBy("shard").applyInArrow(judge_anchors, REPLIES), "repeats-anchors")

    def ask_segments(key, table, told):
        number = key[0].as_py()
        part = Part(table["text"].combine_chunks())
        if not len(part.anchor):
            return _table([], ASK_TYPES)
        codes = part.codes({s: unpack(c, np.uint8) for s, c in _told(told).get(1, {}).items()}, parts)
        rows = []
        for s, own in part.several(codes, parts):
            body, sizes = [], []
            for e in part.example[own]:
                i = int(np.searchsorted(part.bounds, e, side="right")) - 1
                piece = part.slices[i]
                j = int(e - part.bounds[i])
                segment = piece.data[piece.first[j] : piece.last[j] + LENGTH].tobytes()
                body.append(segment)
                sizes.append(len(segment))
            extra = np.stack([part.name[own], part.counts[own].astype(U), np.array(sizes, dtype=U)])
            rows.append((2, s, number, EliasFano.encode(part.anchor[own]), extra.tobytes(), zlib.compress(b"".join(body), 1)))
        _, keys, counts = part.many(codes)
        order, bounds = shard_order(even_shard(keys, parts), parts)
        for s in range(parts):
            own = order[bounds[s] : bounds[s + 1]]
            if len(own):
                rows.append((3, s, number, EliasFano.encode(keys[own]), b"", pack(counts[own].astype(np.uint32))))
        return _table(rows, ASK_TYPES)

    asked = chosen.select("part", "text").groupBy("part").cogroup(anchors.groupBy("part")).applyInArrow(ask_segments, ASKS)
    segments = written(asked.groupBy("kind", "shard").applyInArrow(_judge_segments, REPLIES), "repeats-segments")
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(chosen.schema["doc_id"].dataType)

    def remove(key, table, told):
        part = Part(table["text"].combine_chunks())
        found = _told(told)
        codes = part.codes({s: unpack(c, np.uint8) for s, c in found.get(1, {}).items()}, parts)
        flags: dict[int, np.ndarray] = {}  # by pair
        sizes = np.zeros(len(part.anchor), np.int64)
        for i, piece in enumerate(part.slices):
            sizes[part.index[part.bounds[i] : part.bounds[i + 1]]] = piece.last - piece.first + 1
        for s, own in part.several(codes, parts) if len(codes) else []:
            bits = np.unpackbits(unpack(found[2][s], np.uint8), count=int(sizes[own].sum())).astype(bool)
            for pair, bit in zip(own.tolist(), np.split(bits, np.cumsum(sizes[own])[:-1])):
                flags[pair] = bit
        places, keys, _ = part.many(codes)
        repeated = answers({s: unpack(c, bool) for s, c in found.get(3, {}).items()}, even_shard(keys, parts), parts, len(keys)) if len(keys) else np.zeros(0, bool)
        ids = table["doc_id"].cast(id_type)
        out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
        for i, piece in enumerate(part.slices):
            pairs = part.index[part.bounds[i] : part.bounds[i + 1]]
            edge = np.zeros(len(piece.data) + 1, dtype=np.int32)
            own_codes = codes[pairs]
            windows = [ranges(piece.first[own_codes == SAME], piece.last[own_codes == SAME] + 1)]
            for j in np.flatnonzero(own_codes == SEVERAL):
                windows.append(piece.first[j] + np.flatnonzero(flags[int(pairs[j])]))
            if len(places[i]):
                hashes = range_hash(piece.sums, places[i], places[i] + LENGTH)
                windows.append(places[i][repeated[np.searchsorted(keys, hashes)]])
            at = np.concatenate(windows)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + LENGTH, -1)
            gone = np.cumsum(edge[:-1]) > 0
            begins = gone & ~np.r_[False, gone[:-1]] if len(gone) else gone
            inner = piece.offsets[:-1][piece.offsets[:-1] < piece.offsets[1:]]
            begins[inner] = gone[inner]
            gone_before, begun_before = np.r_[0, np.cumsum(gone)], np.r_[0, np.cumsum(begins)]
            low, high = piece.offsets[:-1], piece.offsets[1:]
            removed = gone_before[high] - gone_before[low]
            out["n_bytes"] += (high - low).tolist()
            out["n_removed"] += removed.tolist()
            out["n_spans"] += (begun_before[high] - begun_before[low]).tolist()
            for a, b, r in zip(low.tolist(), high.tolist(), removed.tolist()):
                kept = (piece.data[a:b][~gone[a:b]] if r else piece.data[a:b]).tobytes()
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    out["kept"].append(kept)
        columns = {"doc_id": ids, **{c: pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")}, "kept_sha256": pa.array(out["kept_sha256"], pa.string())}
        if with_text:
            columns["kept"] = pa.array(out["kept"], pa.binary())
        return pa.table(columns)

    kind = chosen.schema["doc_id"].dataType.simpleString()
    told = anchors.unionByName(segments)
    return chosen.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(
        remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else ""))
