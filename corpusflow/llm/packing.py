"""Packing: vector bin packing of tokenised examples into fixed-length training sequences.

Every task tokenises the documents of its own input split and packs them as they stream by, so
nothing is shuffled or gathered. Full ``max_tokens`` pieces of a long document are sequences by
themselves; the rest goes through :class:`DotProductPacker`.

Defined results: a null text is the empty text (with ``end_id`` it is one token; without, it has
no piece); a null id stays null and is packed like any other; repeated rows are packed as often as
they come; an empty table gives no rows; other columns are ignored. Texts are encoded whole, whatever
their length: those with runs of white space beyond the fast engine's stack by the file's own library.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import prepare

PLACED = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                    ("loss_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PLACED_DDL = ("doc_id long, start long, ids binary, doc_tokens long, loss_tokens long, "
              "sequence_id long, offset long")


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str) -> Callable[[str], np.ndarray]:
    """Encoder of a byte-level BPE vocabulary file (JSON): text -> uint32 ids; none are added, and the
    string of an added token within a text is that token.

    The vocabulary's own ids rank its merges, so the file is run by the faster of the two
    installed engines; tests hold its ids against the file's own library, which encodes what the
    fast one gives up on.
    """
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    # byte-level files write byte b as a printable character: itself, or 256 + its turn
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    ranks = {bytes(byte_of[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
    engine = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    library = functools.cache(lambda: Tokenizer.from_file(path))

    def encode(text: str) -> np.ndarray:
        try:
            return engine.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # its pattern backtracks through a run of white space of some 100,000 characters
            return np.array(library().encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


class DotProductPacker:
    """Streaming packer of one task, under limits on tokens, segments and loss-bearing tokens.

    Items wait in a bounded window. A bin is filled by repeatedly taking, among the waiting items
    that fit its remaining room, the one whose demand has the largest dot product with that room
    (each dimension in units of its limit; ties to the earliest item). When none fits the bin
    closes; with ``cut`` the head of the largest waiting item first fills what is left, and the
    last tokens of the task go to bins of a power of two, which need no padding.

    Placements are (key, start, length, loss tokens, bin, offset).
    """

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int, window: int = 1024, cut: bool = False):
        self.limits = np.array([max_tokens, max_segments, max_loss], dtype=np.float64)
        self.window, self.cut, self.bins, self.n = window, cut, 0, 0
        self.keys = np.zeros(2 * window, dtype=np.int64)
        self.starts = np.zeros(2 * window, dtype=np.int64)
        self.need = np.zeros((2 * window, 3))

    def add(self, key: int, tokens: int, loss: int) -> Iterator[tuple]:
        """Queue an item; yields what its coming closes. An item over a limit is first cut into
        pieces that meet all limits, as it could not be placed otherwise."""
        start = 0
        most = int(self.limits[0])
        while tokens > most or loss > self.limits[2]:
            take = min(tokens, most) if loss <= self.limits[2] else min(tokens, most, int(self.limits[2]))
            borne = min(loss, take)
            yield key, start, take, borne, self.bins, 0
            self.bins += 1
            start, tokens, loss = start + take, tokens - take, loss - borne
        if not tokens:
            return
        self.keys[self.n], self.starts[self.n], self.need[self.n] = key, start, (tokens, 1, loss)
        self.n += 1
        if self.n == 2 * self.window:
            while self.n > self.window:
                yield from self._fill()

    def finish(self) -> Iterator[tuple]:
        while self.n:
            yield from self._fill()

    def _fill(self) -> Iterator[tuple]:
        n, need, starts = self.n, self.need[: self.n], self.starts[: self.n]
        room, offset, waiting = self.limits.copy(), 0, np.ones(n, dtype=bool)
        left = need[:, 0].sum()
        if self.cut and left < room[0]:
            room[0] = 1 << (int(left).bit_length() - 1)
        share = need / self.limits**2
        while room[0] >= 1 and room[1] >= 1:
            fits = waiting & (need[:, 0] <= room[0]) & (need[:, 2] <= room[2])
            if fits.any():
                at = int(np.argmax(np.where(fits, share @ room, -1.0)))
                used = need[at].copy()
                waiting[at] = False
            elif self.cut and waiting.any():
                at = int(np.argmax(np.where(waiting, need[:, 0], -1.0)))
                take = min(room[0], need[at, 0] - 1 if need[at, 2] <= room[2] else room[2])
                if take < 1:
                    break
                used = np.array([take, 1, min(take, need[at, 2])])
            else:
                break
            yield int(self.keys[at]), int(starts[at]), int(used[0]), int(used[2]), self.bins, offset
            offset += int(used[0])
            room -= used
            if waiting[at]:
                starts[at] += int(used[0])
                need[at] -= (used[0], 0, used[2])
                share[at] = need[at] / self.limits**2
        self.bins += 1
        k = int(waiting.sum())
        self.keys[:k], self.starts[:k], self.need[:k] = self.keys[:n][waiting], starts[waiting], need[waiting]
        self.n = k


def pack(docs: DataFrame, encoder: Callable[[], Callable[[str], np.ndarray]], id_col: str = "doc_id",
         text_col: str = "text", loss_col: str | None = None, end_id: int | None = None, max_tokens: int = 2048,
         max_segments: int = 256, max_loss: int | None = None, window: int = 1024, cut: bool = False) -> DataFrame:
    """Pack the tokens of ``docs`` into sequences of at most ``max_tokens`` tokens.

    ``encoder`` is called once a task and returns text -> uint32 ids. ``loss_col`` counts the
    loss-bearing tokens of an example (default: all its tokens); ``end_id`` is appended to each.
    ``cut`` allows examples to be cut anywhere (plain text); without it only an example that is
    over a limit by itself is cut. One row per piece: doc_id, start (its document's tokens before
    it), ids (little-endian uint32), doc_tokens, loss_tokens, sequence_id, offset (gapless from 0).
    """
    prepare(docs.sparkSession)
    most_loss = max_tokens if max_loss is None else max_loss

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(), DotProductPacker(max_tokens, max_segments, most_loss, window, cut)
        base = TaskContext.get().partitionId() << 33
        held: dict[int, list] = {}  # key -> [id, its last ids, tokens not yet placed, tokens in all]
        rows: list[tuple] = []
        end = np.array([] if end_id is None else [end_id], dtype=np.uint32)

        def place(placements):
            for key, start, length, loss, bin_, offset in placements:
                doc = held[key]
                at = start - (doc[3] - len(doc[1]))
                rows.append((doc[0], start, doc[1][at:at + length].tobytes(), doc[3], loss, base + bin_, offset))
                doc[2] -= length
                if not doc[2]:
                    del held[key]

        def taken():
            out = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), PLACED)], schema=PLACED)
            rows.clear()
            return out

        key = 0
        for batch in batches:
            losses = batch.column(2) if loss_col else None
            for i, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                ids = np.concatenate([encode(text.as_py() or ""), end]).astype("<u4", copy=False)
                loss = len(ids) if losses is None else min(max(losses[i].as_py() or 0, 0), len(ids))
                if len(ids):
                    held[key] = doc = [doc_id, ids, len(ids), len(ids)]
                    place(packer.add(key, len(ids), loss))
                    if doc[2] < len(ids):  # only the end of a long document waits in the window
                        doc[1] = ids[len(ids) - doc[2]:].copy()
                    key += 1
                if len(rows) >= 1024:
                    yield taken()
        place(packer.finish())
        if rows:
            yield taken()

    cols = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    cols += [F.col(loss_col).cast("long").alias("loss")] if loss_col else []
    return docs.select(*cols).mapInArrow(run, PLACED_DDL)


def pieces(packed: DataFrame) -> DataFrame:
    """The digest of every piece: its length and CRC-32 instead of its ids."""
    return packed.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
