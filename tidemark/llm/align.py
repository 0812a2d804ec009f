"""Alignment of the tokens of two tokenizers over the same bytes.

Tokens of both are laid over a text's bytes by where they end. A merge walks the two
sequences: the tokens at the pointers overlap and are a link; the one that ends first makes
way for the next, and where both end there, the text is cut into a group. The merge runs in
lockstep: one state vector holds the pointers of all texts of a slice, each step is a few
array operations on all of them, and texts that are done are taken out. Long texts enter as
stretches of their A tokens, which share no link, so a step never waits for one long text.

How often an id pair is linked over the corpus is counted over distinct pairs per text. The
answers go back to the texts in two ways that together are exact: the most frequent pairs,
up to a fixed number, are sent to all tasks; the others, each held by few texts, are joined.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.bytewords import text_slices
from tidemark.llm.store import map_arrow, written

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
STRETCH = 256  # A tokens per entry of the state vector
TOP_PAIRS = 1 << 20  # sent to all tasks: 16 bytes each
HELD = 1 << 20  # pairs counted in a task before they are passed on
SLICE = 1 << 20
PAIR = 1 << 32
#: Fixed value: how byte-level tokenizers without a pattern of their own split a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space runs beyond this are more than the fast encoder's pattern engine takes.
LONG_RUN = re.compile(r"\s{10000}")


class Encoder(NamedTuple):
    """``encode``: a text to ids; ``pieces``: the bytes of each id."""

    encode: Callable[[str], np.ndarray]
    pieces: list[bytes]


def byte_level_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones
    stand for themselves, the others are numbered from 256 on."""
    own = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def byte_level_encoder(source: bytes) -> Encoder:
    """A byte-level BPE tokenizer file, of a space and the text. Its merges are in the order
    of its ids, so the vocabulary serves as ranks for the faster of two encoders; texts whose
    white space that one can't split go to the other, which gives the same ids."""
    import tiktoken
    from tokenizers import Tokenizer

    known = json.loads(source)
    special = {t["content"] for t in known["added_tokens"] if t["special"]}
    alphabet = byte_level_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in known["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("from-file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
    plain = Tokenizer.from_str(source.decode())
    plain.encode_special_tokens = True
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, i in ranks.items():
        pieces[i] = piece

    def encode(text: str) -> np.ndarray:
        text = " " + text
        if LONG_RUN.search(text):
            return np.array(plain.encode(text, add_special_tokens=False).ids, dtype=np.int64)
        return np.array(fast.encode_ordinary(text), dtype=np.int64)

    return Encoder(encode, pieces)


@lru_cache(maxsize=2)
def piece_encoder(source: bytes) -> Encoder:
    """A sentence-piece model file, which adds the space itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=source)
    pieces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        pieces.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return Encoder(lambda text: np.array(model.encode(text, num_threads=1), dtype=np.int64), pieces)


class Sides(NamedTuple):
    """Tokens of one tokenizer for the texts of a slice, one after another."""

    ids: np.ndarray
    ends: np.ndarray  # byte ends within the texts joined
    bounds: np.ndarray  # texts + 1


class Links(NamedTuple):
    text: np.ndarray
    a: np.ndarray  # places of the tokens in their sides
    b: np.ndarray
    cut_a: np.ndarray  # in order: tokens up to each cut
    cut_b: np.ndarray


def lockstep(a: Sides, b: Sides) -> Links:
    """Overlapping tokens and common ends of two tokenisations of the same texts."""
    count = np.diff(a.bounds)
    per_text = -(-count // STRETCH)
    text = np.repeat(np.arange(len(count)), per_text)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    # The state: pointers, where the stretch ends, its text.
    at_a = a.bounds[text] + nth * STRETCH
    stop = np.minimum(at_a + STRETCH, a.bounds[text + 1])
    begin = np.concatenate([[0], a.ends])[at_a]
    at_b = np.searchsorted(b.ends, begin, side="right")
    found: list[list[np.ndarray]] = [[], [], [], [], []]
    while len(text):
        end_a, end_b = a.ends[at_a], b.ends[at_b]
        both = end_a == end_b
        for kept, values in zip(found, (text, at_a, at_b, at_a[both], at_b[both])):
            kept.append(values)
        at_a, at_b = at_a + (end_a <= end_b), at_b + (end_b <= end_a)
        going = at_a < stop
        if not going.all():
            text, at_a, at_b, stop = text[going], at_a[going], at_b[going], stop[going]
    whole = [np.concatenate(f) if f else np.zeros(0, np.int64) for f in found]
    return Links(*whole[:3], np.sort(whole[3]) + 1, np.sort(whole[4]) + 1)


@lru_cache(maxsize=8)
def _written_ids(size: int, mark: str) -> np.ndarray:
    """Decimal ids followed by a mark, as 8 bytes each, the rest zeros."""
    table = np.array([f"{i}{mark}".encode() for i in range(size)], dtype="S8")
    return np.frombuffer(table.tobytes(), dtype=np.uint64)


def group_texts(a: Sides, b: Sides, links: Links, sizes: tuple[int, int]) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text."""
    texts = len(a.bounds) - 1
    if not len(links.cut_a):
        return [b""] * texts
    out = np.zeros(len(a.ids) + len(b.ids), dtype=np.uint64)
    # A token comes after the A tokens before it and the B tokens of the groups before its own.
    for side, own, other, shift, mark, size in ((a, links.cut_a, links.cut_b, 0, "|", sizes[0]), (b, links.cut_b, links.cut_a, 1, ";", sizes[1])):
        place = np.arange(len(side.ids))
        group = np.searchsorted(own, place, side="right")
        before = np.concatenate([[0], other])[group + shift]
        words = _written_ids(size, ",")[side.ids]
        last = own - 1
        words[last] = _written_ids(size, mark)[side.ids[last]]
        out[place + before] = words
    letters = out.view(np.uint8)
    used = letters != 0
    ends = np.concatenate([[0], np.cumsum(used.reshape(-1, 8).sum(axis=1))])
    whole = letters[used].tobytes()
    bounds = ends[a.bounds + b.bounds]
    return [whole[x : y - 1] if y > x else b"" for x, y in zip(bounds[:-1], bounds[1:])]


def side_of(encoder: Encoder, texts: list[str]) -> tuple[Sides, list[bool]]:
    """Tokens of the texts, and whether joined they are a space and the text. Of texts for
    which they are not, none are kept."""
    lengths = np.array([len(p) for p in encoder.pieces], dtype=np.int64)
    ids, good = [], []
    for text in texts:
        found = encoder.encode(text) if text else np.zeros(0, np.int64)
        good.append(bool(text) and b"".join([encoder.pieces[i] for i in found.tolist()]) == b" " + text.encode())
        ids.append(found)
    whole = np.concatenate([*ids, np.zeros(0, np.int64)])
    bounds = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64)
    return Sides(whole, np.cumsum(lengths[whole]), bounds), good


def _only(side: Sides, keep: np.ndarray, encoder: Encoder) -> Sides:
    if keep.all():
        return side
    count = np.diff(side.bounds)
    ids = side.ids[np.repeat(keep, count)]
    lengths = np.array([len(p) for p in encoder.pieces], dtype=np.int64)
    return Sides(ids, np.cumsum(lengths[ids]), np.concatenate([[0], np.cumsum(np.where(keep, count, 0))]))


def pack_pairs(keys: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted distinct pairs and how often each occurs in a text."""
    if not len(keys):
        return b""
    return zlib.compress(np.diff(keys, prepend=0).tobytes() + times.astype(np.int32).tobytes(), 1)


def unpack_pairs(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = zlib.decompress(block) if block else b""
    n = len(data) // 12
    return np.cumsum(np.frombuffer(data, dtype=np.int64, count=n)), np.frombuffer(data, dtype=np.int32, offset=8 * n)


def aligned(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B, digest: bool = False) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``groups`` (token ids between common ends, as ``a1,a2|b1;a3|b2,b3``, or with ``digest``
    its SHA-256) and ``pairs`` (see ``unpack_pairs``; a pair is A id * 2**32 + B id).

    ``tokenizer_a`` is a byte-level file and sees a space before the text, ``tokenizer_b`` a
    sentence-piece model that adds it. Texts are encoded whole; strings of special tokens
    are plain text. Null and empty texts, and those whose tokens of either side do not make up
    a space and the text, have no tokens: zeros and empty strings. Repeated rows stay, other columns
    are not read, whatever their names; an empty table gives an empty result.
    """
    # Vocabularies have a fixed size; executors need not have the files.
    shared = docs.sparkSession.sparkContext.broadcast((Path(tokenizer_a).read_bytes(), Path(tokenizer_b).read_bytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = byte_level_encoder(shared.value[0]), piece_encoder(shared.value[1])
        sizes = len(first.pieces), len(second.pieces)
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(1), SLICE):
                texts = [data[x:y].tobytes().decode() for x, y in zip(offsets[:-1], offsets[1:])]
                (a, good_a), (b, good_b) = side_of(first, texts), side_of(second, texts)
                keep = np.array(good_a) & np.array(good_b)
                a, b = _only(a, keep, first), _only(b, keep, second)
                links = lockstep(a, b)
                groups = group_texts(a, b, links, sizes)
                if digest:
                    groups = [hashlib.sha256(g).hexdigest().encode() if g else g for g in groups]
                cuts = np.searchsorted(links.cut_a, a.bounds, side="right")
                order = np.argsort(links.text, kind="stable")
                keys = (a.ids[links.a] * PAIR + b.ids[links.b])[order]
                ends = np.searchsorted(links.text[order], np.arange(len(texts) + 1))
                packed = [pack_pairs(*np.unique(keys[x:y], return_counts=True)) for x, y in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(texts)), *[pa.array(np.diff(v), pa.int64()) for v in (a.bounds, b.bounds, cuts, ends)], pa.array([g.decode() for g in groups]), pa.array(packed, pa.binary())],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"])

    kind = docs.schema[id_column].dataType.simpleString()
    return map_arrow(docs.select(id_column, text_column), run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary")


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n, best): in how many rows of ``aligned`` each pair occurs, and whether no pair
    of its A id occurs in more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)

        held, rows = [], 0
        for batch in batches:
            for block in batch.column(0):
                keys, _ = unpack_pairs(block.as_py())
                held.append((keys, np.ones(len(keys), np.int64)))
                rows += len(keys)
                if rows > 4 * HELD:
                    held = [added(held)]
                    rows = len(held[0][0])
                    if rows > HELD:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, held[0])), names=["pair", "n"])
                        held, rows = [], 0
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, added(held))), names=["pair", "n"])

    a = F.shiftright("pair", 32).alias("a")
    counts = written(map_arrow(found.select("pairs"), run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "align-counts")
    most = counts.groupBy(a).agg(F.max("n").alias("most"))  # at most a row per A id
    return counts.withColumn("a", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _least_of_top(counts: DataFrame, limit: int) -> int:
    """Least count such that no more than ``limit`` pairs reach it, among 256 levels."""
    level = F.floor(F.log2("n") * 4).cast("int")
    rows = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least")).orderBy(F.desc("level")).collect()
    total, least = 0, None
    for r in rows:
        total += r["pairs"]
        if total > limit:
            break
        least = r["least"]
    return 1 << 62 if least is None else least


def align(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B, digest: bool = False, top: int = TOP_PAIRS) -> DataFrame:
    """The columns of ``aligned`` but ``pairs``, with ``n_best`` (links whose pair is in as many
    rows as any pair of its A id) and ``count_sum`` (over links, the rows that hold their
    pair), from the counts of all rows. ``top`` bounds what is sent to every task and bears on cost only.
    Odd texts and tables as there.
    """
    found = aligned(docs, id_column, text_column, tokenizer_a, tokenizer_b, digest).withColumn("row", F.monotonically_increasing_id())
    found = written(found, "align-found")  # from here on the row numbers are fixed
    counts = written(pair_counts(found), "align-pairs")
    least = _least_of_top(counts, top)
    # Numbers on the way to the driver: 17 bytes for at most ``top`` pairs.
    common = counts.where(F.col("n") >= least).toArrow().sort_by("pair")
    keys, n, best = (common.column(c).to_numpy() for c in ("pair", "n", "best"))
    shared = docs.sparkSession.sparkContext.broadcast((keys, n, best.astype(np.int64)))

    def known(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        pairs, times = unpack_pairs(block)
        at = np.searchsorted(shared.value[0], pairs)
        has = at < len(shared.value[0])
        has[has] = shared.value[0][at[has]] == pairs[has]
        return pairs, times, at, has

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, n, best = shared.value
        for batch in batches:
            n_best, count_sum = [], []
            for block in batch.column(0):
                _, times, at, has = known(block.as_py())
                n_best.append(int((times[has] * best[at[has]]).sum()))
                count_sum.append(int((times[has] * n[at[has]]).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())], names=[*batch.schema.names[1:], "n_best", "count_sum"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                pairs, times, _, has = known(block.as_py())
                if not has.all():
                    rest = ~has
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(int(rest.sum()), row)), pa.array(pairs[rest]), pa.array(times[rest])], names=["row", "pair", "times"])

    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "row"]
    kinds = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns)
    mostly = map_arrow(found.select("pairs", *columns), sums, f"{schema}, n_best long, count_sum long")
    rare = map_arrow(found.select("row", "pairs"), others, "row long, pair long, times int").join(counts.where(F.col("n") < least), "pair")
    rest = rare.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    whole = mostly.join(rest, "row", "left")
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).cast("long").alias("n_best"),
                        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).cast("long").alias("count_sum"), "groups")
