"""Word-piece counts by an automaton with failure links (linear longest match).

The vocabulary is a trie. When a match can't go on, the failure link of a node names the
node for what remains after the longest pieces have been taken off its string from the left,
and the node stores how many pieces that takes. So a word is counted in one pass over its
characters, no character is read twice, and no piece is built.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.store import map_arrow

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
WORD_MARK = "▁"
CACHE_WORDS = 1 << 17


class PieceAutomaton:
    """``starts``: pieces that begin a word; ``continues``: pieces that may follow."""

    def __init__(self, starts: set[str], continues: set[str]) -> None:
        self.next: list[dict[str, int]] = [{}, {}]
        self.fail = [-1, -1]
        self.popped = [0, 0]
        ends = [False, False]
        for root, pieces in ((0, starts), (1, continues)):
            for piece in sorted(p for p in pieces if p):
                at = root
                for c in piece:
                    to = self.next[at].get(c)
                    if to is None:
                        to = len(self.next)
                        self.next[at][c] = to
                        self.next.append({})
                        self.fail.append(-1)
                        self.popped.append(0)
                        ends.append(False)
                    at = to
                ends[at] = True
        # Breadth first, so the links of shorter strings are there when longer ones need them.
        queue = deque([(0, c, v) for c, v in self.next[0].items()] + [(1, c, v) for c, v in self.next[1].items()])
        while queue:
            parent, c, node = queue.popleft()
            if ends[node]:
                self.fail[node], self.popped[node] = 1, 1
            else:
                at, n = self.fail[parent], self.popped[parent]
                while at >= 0 and c not in self.next[at]:
                    n += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.next[at][c], n
            queue.extend((node, d, v) for d, v in self.next[node].items())

    def count(self, word: str) -> int:
        """Pieces of the greedy longest match; -1 if some character can't be matched."""
        at, n = 0, 0
        for c in word:
            while True:
                to = self.next[at].get(c)
                if to is not None:
                    at = to
                    break
                if self.fail[at] < 0:
                    return -1
                n += self.popped[at]
                at = self.fail[at]
        while at != 1:
            if self.fail[at] < 0:
                return -1 if at else 0
            n += self.popped[at]
            at = self.fail[at]
        return n


def pieces_of(path: str) -> tuple[set[str], set[str]]:
    """Starting and continuing pieces of a tokenizer file whose pieces mark word starts."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    starts, continues = set(), set()
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        if piece.startswith(WORD_MARK):
            starts.add(piece[1:])
        else:
            continues.add(piece)
    return starts - {""}, continues


def count_tokens(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words`` (runs without white space),
    ``n_tokens`` (greedy pieces; a word with a character that no piece matches counts as one)
    and ``n_unknown`` (those words).

    A word starts with a piece that begins words, or, if none matches there, with a
    continuing piece. The vocabulary has a fixed size and is sent to the executors once.
    Texts are read whole; counts of frequent words are kept per task, up to a bound that
    changes no result. Null and empty texts have no tokens. Rows stay as they are, repeated
    or not; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    starts, continues = pieces_of(tokenizer)
    shared = spark.sparkContext.broadcast((starts | continues, continues))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = PieceAutomaton(*shared.value)
        known: dict[str, int] = {}
        for batch in batches:
            rows: list[tuple[int, int, int]] = []
            for value in batch.column(1):
                words = (value.as_py() or "").translate(TO_SPACE).split(" ")
                n_words = n_tokens = n_unknown = 0
                for word in words:
                    if not word:
                        continue
                    n_words += 1
                    n = known.get(word)
                    if n is None:
                        n = automaton.count(word)
                        if len(word) <= 64:
                            if len(known) >= CACHE_WORDS:
                                known.clear()
                            known[word] = n
                    if n < 0:
                        n_unknown += 1
                        n = 1
                    n_tokens += n
                rows.append((n_words, n_tokens, n_unknown))
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    kind = docs.select(id_column).schema[0].dataType.simpleString()
    return map_arrow(docs.select(id_column, text_column), counted, f"doc_id {kind}, n_words long, n_tokens long, n_unknown long")


TO_SPACE = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})
