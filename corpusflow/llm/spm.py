"""SentencePiece encoding and decoding by a streaming Viterbi.

A text gets the segmentation into vocabulary pieces of the highest total score. Only a window of
the longest piece's length can still be extended; whenever all paths that survive in it agree on
the next boundary, the piece before it is committed and forgotten. Where no piece of the
vocabulary reaches over a word's start or between letters and other characters, paths always agree,
so words are remembered by worker.

Characters outside the vocabulary become byte pieces, and so does a literal U+2581, which makes
decoding exact. Files of merge ranks (BPE) have no probabilities: their ranks r are read as Zipf
log-probabilities -ln((r + 1) H), H the harmonic sum over the vocabulary. Scores are whole
millionths, so equal sums are equal wherever a text is cut.

Defined results: a null text has null ids, an empty text none; equal scores prefer the longer last
piece; a text of any length is encoded whole; repeated rows are encoded alike; an empty table gives no rows; other columns are kept (one
of the output's name is replaced).
"""

from __future__ import annotations

import functools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import prepare

#: The mark of a space in vocabulary files; inside this module a piece has the space itself.
MARK = "▁"
LETTER = r"[^\W\d_²³¹¼-¾]"  # without the Latin-1 superscripts and fractions, which re counts among letters
#: Runs of letters or of other characters, with the spaces before them.
WORDS = re.compile(f" *{LETTER}+| *(?:(?!{LETTER})[^ ])+| +")
MEMO, MEMO_CHARS = 400_000, 40


class _Memo(dict):
    """Ids of words seen, emptied when full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        got = self.encode(word)
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[word] = got
        return got


class Vocabulary:
    """Pieces with their ids and scores; ``raw`` has the bytes that every id decodes to. ``trie``
    leads from character to character; a piece's score stands under the empty string."""

    def __init__(self, pieces: list[tuple[str, int, float]], bytes_: list[int], raw: list[bytes]):
        self.ids = {p: i for p, i, _ in pieces}
        self.scores = {p: round(s * 1_000_000) for p, _, s in pieces}
        self.bytes, self.raw = bytes_, raw
        self.byte_score = min(self.scores.values(), default=0) - 10_000_000
        self.longest = max(map(len, self.ids), default=1)
        self.splits = all(len(WORDS.findall(p)) == 1 for p in self.ids)
        self.trie: dict = {}
        for piece, score in self.scores.items():
            node = self.trie
            for ch in piece:
                node = node.setdefault(ch, {})
            node[""] = score
        self._memo = _Memo(self.encode_word)

    def segment(self, text: str) -> Iterator[tuple[int, int]]:
        """Boundaries of the pieces, each as soon as it is certain.

        ``best`` and ``back`` hold the boundaries from ``base``, the last committed one, to the longest
        piece's reach. Every path goes on through a boundary that is reached but not passed; these are
        followed back until they meet, once in a window's length, and all before that is committed.
        """
        trie, scores, reach, low = self.trie, self.scores, self.longest, -(1 << 62)
        n, base, due = len(text), 0, self.longest
        best, back = [0] + [low] * reach, [0] * (reach + 1)
        for i in range(n):
            here, node = best[i - base], trie
            for j in range(i + 1, n + 1):
                node = node.get(text[j - 1])
                if node is None:
                    break
                s = node.get("")
                if s is not None and here + s > best[j - base]:
                    best[j - base], back[j - base] = here + s, i
            if text[i] not in scores:
                s = here + self.byte_score * len(text[i].encode("utf-8"))
                if s > best[i + 1 - base]:
                    best[i + 1 - base], back[i + 1 - base] = s, i
            best.append(low)
            back.append(0)
            if i >= due:
                due = i + reach
                met = self._meeting(best, back, base, i + 1)
                yield from self._path(back, base, met)
                best, back, base = best[met - base:], back[met - base:], met
        yield from self._path(back, base, n)

    @staticmethod
    def _meeting(best: list[int], back: list[int], base: int, open_from: int) -> int:
        """The last boundary that the paths to all reached boundaries from ``open_from`` on share."""
        live = {base + k for k in range(open_from - base, len(best)) if best[k] > -(1 << 62)}
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(back[last - base])
        return live.pop()

    @staticmethod
    def _path(back: list[int], base: int, end: int) -> list[tuple[int, int]]:
        """The pieces of the path from ``base`` to ``end``."""
        out = []
        while end > base:
            out.append((back[end - base], end))
            end = back[end - base]
        return out[::-1]

    def encode_word(self, word: str) -> bytes:
        """Ids of a text without literal U+2581, as little-endian uint32."""
        out: list[int] = []
        for i, j in self.segment(word):
            piece = word[i:j]
            got = self.ids.get(piece)
            out += [got] if got is not None else [self.bytes[b] for b in piece.encode("utf-8")]
        return struct.pack(f"<{len(out)}I", *out)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        literal = struct.pack("<3I", *(self.bytes[b] for b in MARK.encode("utf-8")))
        out = []
        for part in (" " + text).split(MARK):
            words = WORDS.findall(part) if self.splits else [part] if part else []
            out.append(b"".join(map(self._memo.__getitem__, words)))
        return literal.join(out)

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace")[1:]


@functools.lru_cache(maxsize=2)
def load(path: str, zipf: bool = True) -> Vocabulary:
    """Vocabulary of a SentencePiece file with byte pieces; ``zipf`` for files of merge ranks."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    harmonic = float((1 / np.arange(1, n + 1)).sum())
    order = sorted(range(n), key=lambda i: (-sp.get_score(i), i))
    rank = {i: k for k, i in enumerate(order)}
    pieces, bytes_, raw = [], [0] * 256, [b""] * n
    for i in range(n):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            value = int(piece[3:5], 16)  # <0xNN>
            bytes_[value], raw[i] = i, bytes([value])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces.append((piece.replace(MARK, " "), i, -float(np.log((rank[i] + 1) * harmonic)) if zipf else sp.get_score(i)))
            raw[i] = piece.replace(MARK, " ").encode("utf-8")
    return Vocabulary(pieces, bytes_, raw)


def encode(docs: DataFrame, vocabulary, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text_col`` as little-endian uint32 in a binary column.
    ``vocabulary`` is called in the workers and returns a :class:`Vocabulary`."""
    prepare(docs.sparkSession)

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = vocabulary()
        for texts in batches:
            yield pa.array([None if t is None else v.encode(t) for t in texts.to_pylist()], pa.binary())

    return docs.withColumn(out_col, ids.asNondeterministic()(F.col(text_col)))


def decode(docs: DataFrame, vocabulary, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of the ids."""
    prepare(docs.sparkSession)

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = vocabulary()
        for ids in batches:
            yield pa.array([None if b is None else v.decode(b) for b in ids.to_pylist()], pa.string())

    return docs.withColumn(out_col, text(F.col(ids_col)))
