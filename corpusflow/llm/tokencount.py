"""Token counts: greedy longest-match word pieces, counted by a linear automaton.

The vocabulary is a trie with failure links: a link leads from a matched string to what is left of
it after its longest pieces are taken off, and carries how many pieces those are. So a word is
scanned once, character by character, and its count is known without any piece being built.

Defined results: a null or empty text, or one of white space only, has no words and no tokens; a
word that greedy matching cannot finish is one unknown token; repeated rows are counted alike; an
empty table gives no rows; other columns are kept (one of the output's name is replaced).
"""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import prepare

MEMO, MEMO_CHARS = 300_000, 40
COUNTS = pa.struct([("words", pa.int64()), ("tokens", pa.int64()), ("unknown", pa.int64())])


class LongestMatch:
    """Automaton over pieces that begin a word and pieces that continue one."""

    BEGIN, CONTINUE = 0, 1

    def __init__(self, begins: Iterable[str], continues: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        ends = [False, False]
        for root, pieces in ((self.BEGIN, begins), (self.CONTINUE, continues)):
            for piece in pieces:
                node = root
                for ch in piece:
                    to = self.next[node].get(ch)
                    if to is None:
                        to = self.next[node][ch] = len(self.next)
                        self.next.append({})
                        ends.append(False)
                    node = to
                ends[node] = ends[node] or node > self.CONTINUE
        # breadth first: the failure target of a string is shorter than the string
        self.fail: list[int] = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        queue = deque([self.BEGIN, self.CONTINUE])
        while queue:
            parent = queue.popleft()
            for ch, node in self.next[parent].items():
                queue.append(node)
                if ends[node]:
                    self.fail[node], self.popped[node] = self.CONTINUE, 1
                    continue
                at, popped = self.fail[parent], self.popped[parent]
                while at >= 0 and ch not in self.next[at]:
                    popped += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.next[at][ch], popped

    def count(self, word: str) -> int:
        """Number of greedy pieces of a word; 0 if it cannot be finished."""
        node, n = self.BEGIN, 0
        for ch in word:
            while ch not in self.next[node]:
                n += self.popped[node]
                node = self.fail[node]
                if node < 0:
                    return 0
            node = self.next[node][ch]
        while node != self.CONTINUE:
            n += self.popped[node]
            node = self.fail[node]
            if node < 0:
                return 0
        return n


@functools.lru_cache(maxsize=2)
def load(path: str) -> LongestMatch:
    """Word-piece vocabulary of a SentencePiece file: pieces after its word mark begin a word,
    pieces without it continue one; a single character may do either."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
    begins = {p[1:] for p in pieces if p[0] == "▁" and len(p) > 1 and "▁" not in p[1:]}
    continues = {p for p in pieces if "▁" not in p}
    return LongestMatch(begins | {p for p in continues if len(p) == 1}, continues)


def count_tokens(docs: DataFrame, vocabulary, text_col: str = "text", out_col: str = "token_count") -> DataFrame:
    """``docs`` with struct<words, tokens, unknown> of the white-space separated words of each
    whole text. ``vocabulary`` is called in the workers and returns a :class:`LongestMatch`."""
    prepare(docs.sparkSession)

    @F.arrow_udf("words long, tokens long, unknown long")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = vocabulary()

        class Known(dict):
            def __missing__(self, word):
                n = automaton.count(word)
                if len(word) <= MEMO_CHARS:
                    if len(self) >= MEMO:
                        self.clear()
                    self[word] = n
                return n

        memo = Known()
        for texts in batches:
            rows = []
            for t in texts.to_pylist():
                per_word = [memo[w] for w in (t or "").split()]
                unknown = per_word.count(0)
                rows.append((len(per_word), sum(per_word) + unknown, unknown))
            yield pa.StructArray.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], fields=list(COUNTS))

    return docs.withColumn(out_col, counts(F.col(text_col)))
