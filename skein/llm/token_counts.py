"""Token counts: greedy longest-match word-piece lengths by a linear automaton.

The vocabulary is a byte trie. Every trie node has a failure link and the number of pieces popped
when it is followed: where the longest match breaks off, the automaton adds that count and goes on
from the link's node without reading a byte again. A word of n bytes therefore takes O(n) steps, and
no piece is ever built. Every single byte is a piece (byte fallback), so each word can be matched.

Scale: one pass, no shuffle. A worker keeps the counts of words it has met in a table of bounded
size, so frequent words cost one lookup.

Defined results: a null text has no words and no tokens, as an empty one. Repeated rows are counted
each by itself. Words are maximal runs of bytes other than ``[\\x20\\x09-\\x0D]``; each word is
matched as the word mark U+2581 followed by the word.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common

MARK = "▁".encode()
#: Words whose counts a worker remembers at a time.
KNOWN_WORDS = 300_000


class Automaton:
    """Byte trie of the vocabulary with failure links and popped-piece counts."""

    def __init__(self, pieces):
        self.next: list[dict[int, int]] = [{}]
        self.final = [False]
        depth = [0]
        for piece in {*pieces, *(bytes([b]) for b in range(256))} - {b""}:
            node = 0
            for b in piece:
                child = self.next[node].get(b)
                if child is None:
                    child = len(self.next)
                    self.next[node][b] = child
                    self.next.append({})
                    self.final.append(False)
                    depth.append(depth[node] + 1)
                node = child
            self.final[node] = True
        # Popping at a node gives up the longest piece on its path (and, from what is left, as many
        # more as needed) until the rest is itself a path of the trie: `link` is that path's node.
        self.link = [0] * len(self.next)
        self.popped = [0] * len(self.next)
        queue = deque(self.next[0].items())
        parents = {child: (0, b) for b, child in self.next[0].items()}
        while queue:
            b, node = queue.popleft()
            parent, _ = parents.pop(node)
            if self.final[node]:
                self.link[node], self.popped[node] = 0, 1  # the whole path is one piece
            else:
                at, count = self.link[parent], self.popped[parent]
                while b not in self.next[at]:
                    count += self.popped[at]
                    at = self.link[at]
                self.link[node], self.popped[node] = self.next[at][b], count
            for c, child in self.next[node].items():
                parents[child] = (node, c)
                queue.append((c, child))

    def count(self, data: bytes) -> int:
        """Number of greedy longest-match pieces of ``data``."""
        nxt, link, popped = self.next, self.link, self.popped
        node = total = 0
        for b in data:
            to = nxt[node].get(b)
            while to is None:
                total += popped[node]
                node = link[node]
                to = nxt[node].get(b)
            node = to
        while node:
            total += popped[node]
            node = link[node]
        return total


class _Counts(dict):
    """word -> number of pieces, filled on demand, emptied when full."""

    def __init__(self, automaton: Automaton, limit: int):
        super().__init__()
        self.automaton, self.limit = automaton, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        n = self[word] = self.automaton.count(MARK + word)
        return n


_LOADED: dict[str, _Counts] = {}


def load_pieces(path: str) -> list[bytes]:
    """Pieces of a sentencepiece model without its control, unknown and byte symbols."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i).encode() for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def _counts(path: str) -> _Counts:
    if path not in _LOADED:
        _LOADED[path] = _Counts(Automaton(load_pieces(path)), KNOWN_WORDS)
    return _LOADED[path]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens, max_word_tokens) of every row.

    ``vocabulary`` is the path of a sentencepiece model file that every worker can open.
    """
    common.prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches):
        counts = _counts(vocabulary)
        for batch in batches:
            words_n, tokens_n, most = [], [], []
            for text in common.as_bytes(batch.column(1)):
                each = [counts[w] for w in text.split()] if text else []
                words_n.append(len(each))
                tokens_n.append(sum(each))
                most.append(max(each, default=0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (words_n, tokens_n, most))],
                ["doc_id", "n_words", "n_tokens", "max_word_tokens"])

    return narrow.mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long, max_word_tokens long")


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(common.table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
