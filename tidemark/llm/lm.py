"""Language model scores from an n-gram trie in Elias-Fano levels.

Level 1 holds the training counts of tokens, level 2 those of pairs. A trie of level 2 is
built per shard: its contexts in increasing order, monotone pointers to where the successors
of each begin, and the successors of all contexts as one monotone sequence (the rank of the
context above the successor). All three are Elias-Fano blocks, with a quantised value per
pair. A pair is looked up by the context, then among the successors of that context alone.
A context's successors are dealt to 16 groups, so one frequent word is no shard of its own.

The probability of a word after another mixes the pair's count with the base model in the
proportion of the context's count to ``PRIOR_COUNT`` (a Dirichlet prior), so it is smooth for
pairs and words never seen.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.bytewords import U, text_slices, words_of
from tidemark.llm.eliasfano import EliasFano
from tidemark.llm.exchange import ASKS, answers, asks, asks_table, even_shard, pack, parts_of, unpack, with_part
from tidemark.llm.store import ship, written

END = U(0x5851F42D4C957F2D)  # the end token, and the context of a first word
PRIOR_COUNT = 500.0
STEPS = 2048  # quantised values: base-2 logarithm of the count in so many steps
WORD_BITS = 28  # of a pair's key; the context has the other 36
REPLIES = "part int, level int, shard int, codes binary, tokens long, distinct long, trie binary"
REPLY_TYPES = pa.schema([("part", pa.int32()), ("level", pa.int32()), ("shard", pa.int32()), ("codes", pa.binary()), ("tokens", pa.int64()), ("distinct", pa.int64()), ("trie", pa.binary())])


class Tokens:
    """Tokens of the texts of one part, as indexes into its distinct words and pairs."""

    def __init__(self, texts: pa.Array) -> None:
        hashes, docs = [], []
        for row, data, offsets in text_slices(texts):
            words = words_of(data, offsets)
            n = len(offsets) - 1
            at = np.r_[words.doc, np.arange(n)]
            order = np.argsort(at, kind="stable")  # ends come after the words of their text
            hashes.append(np.r_[words.hash, np.full(n, END)][order])
            docs.append(at[order] + row)
        self.doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, U)
        before = np.r_[np.array([END], dtype=U), hashes[:-1]][: len(hashes)]
        pairs = ((before >> U(WORD_BITS)) << U(WORD_BITS)) | (hashes >> U(64 - WORD_BITS))
        self.words, self.word_of = np.unique(hashes, return_inverse=True)
        self.pairs, self.pair_of = np.unique(pairs, return_inverse=True)
        self.before_of = np.searchsorted(self.words, before)

    def shards(self, level: int, shards: int) -> np.ndarray:
        if level == 1:
            return even_shard(self.words, shards)
        return even_shard(self.pairs >> U(WORD_BITS - 4), shards)


class PairTrie:
    """Level 2 of one shard."""

    def __init__(self, block: bytes) -> None:
        self.contexts = EliasFano(block)
        self.pointers = EliasFano(block, self.contexts.end)
        self.successors = EliasFano(block, self.pointers.end)
        self.values = np.frombuffer(block, dtype="<u2", count=self.successors.n, offset=self.successors.end)

    @staticmethod
    def build(keys: np.ndarray, counts: np.ndarray) -> bytes:
        """``keys`` sorted and distinct, counts positive."""
        contexts, first = np.unique(keys >> U(WORD_BITS), return_index=True)
        rank = np.repeat(np.arange(len(contexts), dtype=np.int64), np.diff(np.r_[first, len(keys)]))
        chain = (rank.astype(U) << U(WORD_BITS)) | (keys & U((1 << WORD_BITS) - 1))
        values = np.round(STEPS * np.log2(counts)) + 1
        return b"".join([EliasFano.encode(contexts), EliasFano.encode(np.r_[first, len(keys)]), EliasFano.encode(chain), values.astype("<u2").tobytes()])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, 0 for unknown ones."""
        out = np.zeros(len(keys), dtype=np.uint16)
        if not self.successors.n or not len(keys):
            return out
        context = keys >> U(WORD_BITS)
        n = np.full(len(keys), self.contexts.n)
        rank = self.contexts.search(np.zeros(len(keys)), n, context)
        known = np.flatnonzero(rank < n)
        known = known[self.contexts.access(rank[known]) == context[known]]
        rank = rank[known]
        low, high = self.pointers.access(rank), self.pointers.access(rank + 1)
        wanted = (rank.astype(U) << U(WORD_BITS)) | (keys[known] & U((1 << WORD_BITS) - 1))
        at = self.successors.search(low, high, wanted)
        there = np.flatnonzero(at < high.astype(np.int64))
        there = there[self.successors.access(at[there]) == wanted[there]]
        out[known[there]] = self.values[at[there]]
        return out


def _counted(parts_: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of all parts with their summed counts, those of count 0 left out."""
    keys = np.concatenate([EliasFano(k).decode() for _, k, _ in parts_])
    counts = np.concatenate([unpack(c, np.uint32) for _, _, c in parts_]).astype(np.int64)
    trained = counts > 0
    keys, counts = keys[trained], counts[trained]
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _answer(key, table):
    level, shard = key[0].as_py(), key[1].as_py()
    blocks = list(zip(table["part"].to_pylist(), table["keys"].to_pylist(), table["counts"].to_pylist()))
    keys, counts = _counted(blocks)
    rows = []
    trie = None if level == 1 else PairTrie.build(keys, counts)
    reader = PairTrie(trie) if trie else None
    for part, asked, _ in blocks:
        wanted = EliasFano(asked).decode()
        if level == 1:
            at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
            codes = np.where(keys[at] == wanted, counts[at], 0) if len(keys) else np.zeros(len(wanted), np.int64)
        else:
            codes = reader.find(wanted)
        rows.append((part, level, shard, pack(codes), 0, 0, None))
    rows.append((-1, level, shard, None, int(counts.sum()), len(keys), trie))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), REPLY_TYPES)], schema=REPLY_TYPES)


def score_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", prior_count: float = PRIOR_COUNT, parts: int | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score``.

    Trained on all texts whose crc32 of the id (as text) modulo 7 is not 2; all are scored.
    Counts are of all training texts, none is cut off; rare pairs are kept. Base counts are
    exact, pair counts are quantised to 1/2048 of a doubling, and words are told apart by 64
    bits of hash in level 1 and by 36 (context) and 28 bits (successor) in level 2.

    ``parts``: how many groups the documents are dealt into; one group is held in a task.
    Null and empty texts are one end token. A null id counts as the empty text and so trains.
    Repeated rows are all counted. Empty input: no rows.
    """
    parts = parts or parts_of(docs)
    chosen = with_part(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), "doc_id", "text", parts).withColumn(
        "held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2)
    ship(docs.sparkSession)

    def ask(key, table):
        part = key[0].as_py()
        tokens = Tokens(table["text"].combine_chunks())
        trains = ~table["held_out"].to_numpy(zero_copy_only=False)[tokens.doc]
        rows = []
        for level, keys, index in ((1, tokens.words, tokens.word_of), (2, tokens.pairs, tokens.pair_of)):
            counts = np.bincount(index[trains], minlength=len(keys))
            rows += asks(part, level, keys, counts, tokens.shards(level, parts), parts)
        return asks_table(rows)

    asked = chosen.groupBy("part").applyInArrow(ask, ASKS)
    replies = written(asked.groupBy("level", "shard").applyInArrow(_answer, REPLIES), "lm-trie")
    totals = replies.where("part = -1 and level = 1").agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    n_train, n_distinct = int(totals[0]), int(totals[1])
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(chosen.schema["doc_id"].dataType)

    def score(key, table, told):
        tokens = Tokens(table["text"].combine_chunks())
        n = table.num_rows
        codes: dict[int, dict[int, np.ndarray]] = {1: {}, 2: {}}
        for level, shard, block in zip(told["level"].to_pylist(), told["shard"].to_pylist(), told["codes"].to_pylist()):
            codes[level][shard] = unpack(block, np.int64 if level == 1 else np.uint16)
        counts = answers(codes[1], tokens.shards(1, parts), parts, len(tokens.words)).astype(np.float64)
        values = answers(codes[2], tokens.shards(2, parts), parts, len(tokens.pairs)).astype(np.float64)
        base = (counts + 1) / (n_train + n_distinct + 1)
        pairs = np.where(values > 0, 2 ** ((values - 1) / STEPS), 0)[tokens.pair_of]
        own = (pairs + prior_count * base[tokens.word_of]) / (np.maximum(counts[tokens.before_of], pairs) + prior_count)
        sums = [np.bincount(tokens.doc, weights=w, minlength=n) for w in (np.log10(base)[tokens.word_of], np.log10(own), (counts > 0).astype(float)[tokens.word_of])]
        return pa.table({
            "doc_id": table["doc_id"].cast(id_type), "held_out": table["held_out"],
            "n_tokens": np.bincount(tokens.doc, minlength=n).astype(np.int64), "n_known": sums[2].astype(np.int64),
            "train_tokens": np.full(n, n_train), "base_score": sums[0], "score": sums[1]})

    kind = chosen.schema["doc_id"].dataType.simpleString()
    told = replies.where("part >= 0").select("part", "level", "shard", "codes")
    return chosen.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
