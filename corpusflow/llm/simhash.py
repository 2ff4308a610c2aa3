"""SimHash near-dedup by meet-in-the-middle ball hashing.

Fingerprints within ``radius`` 3 of each other have a variant in common when each side flips at
most half of the differing bits. Parity says which half: flipping one bit of an odd fingerprint
and none or two of an even one gives even variants (distances 1 and 3), flipping one bit of
either meets for distance 2. Of three differing bits two lie in the same half of the word, so the
two-bit variants need only pairs within a half.

Defined results: a null or empty text has no words and so fingerprint zero, which links like any
other; rows without an id get a fingerprint but are never the smallest id of a component (a
component of such rows alone has a null id); repeated rows keep one output row each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import connected_components, cut_lineage, prepare, written

BITS = 64
#: Shingle hashes whose bits are counted at a time.
CHUNK = 1 << 16
#: Variants that one bucket holds on average; a variant's own members are at most a ball.
BUCKET_VARIANTS = 2_000_000


def fingerprint(text: str | None, words_per_shingle: int, digest) -> int:
    """Unsigned fingerprint of a whole text: the bits set in over half of its shingle hashes."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(words_per_shingle, len(words))
    lasts = ends[k - 1:]
    firsts = np.concatenate([[0], ends[:len(ends) - k] + 1])
    counts, n = np.zeros(BITS, dtype=np.int64), len(lasts)
    for at in range(0, n, CHUNK):
        pairs = zip(firsts[at:at + CHUNK].tolist(), lasts[at:at + CHUNK].tolist())
        h = np.array([digest(joined[i:j], 42) for i, j in pairs], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(sum(1 << b for b in np.flatnonzero(2 * counts > n).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3,
                 also: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's 64 bits as a signed long) and the long columns ``also`` of every row."""
    prepare(docs.sparkSession)
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "fp", *also)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            fp = np.array([fingerprint(t.as_py(), words_per_shingle, xxhash.xxh64_intdigest) for t in b.column(1)],
                          dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]], schema=schema)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *also)
            .mapInArrow(run, ", ".join(f"`{c}` long" for c in schema.names)))


def ball_masks(radius: int) -> tuple[np.ndarray, int, int]:
    """Flip masks in order (none, single bits, pairs within a half) and how many of them an odd
    and an even fingerprint flips."""
    if radius not in (2, 3):
        raise ValueError("radius must be 2 or 3")
    singles = [1 << i for i in range(BITS)]
    pairs = [1 << i | 1 << j for half in (range(32), range(32, 64)) for i, j in combinations(half, 2)]
    masks = np.array([0, *singles, *(pairs if radius == 3 else [])], dtype=np.uint64)
    return masks, 1 + BITS, len(masks)


def _emit(radius: int, buckets: int):
    """Variants of each batch of fingerprints, dealt to buckets by a hash of the variant. A row
    holds, for one bucket: fingerprints, how many of their variants fall there, and which masks."""
    masks, odd_n, even_n = ball_masks(radius)
    schema = pa.schema([("bucket", pa.int64()), ("fps", pa.binary()), ("counts", pa.binary()), ("masks", pa.binary())])

    def deal(fps: np.ndarray):
        odd = np.bitwise_count(fps) & 1 == 1
        who = np.concatenate([np.repeat(np.flatnonzero(odd), odd_n), np.repeat(np.flatnonzero(~odd), even_n)]).astype(np.int64)
        mask = np.concatenate([np.tile(np.arange(odd_n), int(odd.sum())), np.tile(np.arange(even_n), int((~odd).sum()))])
        bucket = _bucket_of(fps[who] ^ masks[mask], buckets)
        order = np.argsort(bucket, kind="stable")
        who, mask, bucket = who[order], mask[order].astype("<u2"), bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]):
            runs = np.flatnonzero(np.diff(who[i:j], prepend=-1))
            counts = np.diff(np.append(runs, j - i)).astype("<u2")
            yield int(bucket[i]), fps[who[i:j][runs]].astype("<u8").tobytes(), counts.tobytes(), mask[i:j].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 2048):
                rows = list(zip(*deal(fps[at:at + 2048])))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(rows, schema)], schema=schema)

    return run


def _bucket_of(variants: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (variants ^ (variants >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that keep the components of the edges (a, b), at most one a node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(at[:len(a)].tolist(), at[len(a):].tolist()):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    root = np.array([find(x) for x in range(len(nodes))], dtype=np.int64)
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _collide(radius: int):
    """Links of one bucket. All odd members of a variant are within the radius of one another and
    of its even members, and all even members of an odd variant are; so a star around one of them
    keeps every link's component. Every star edge's distance is verified."""
    masks, _, _ = ball_masks(radius)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fps, which = [], []
        for f, c, m in zip(pdf["fps"], pdf["counts"], pdf["masks"]):
            fps.append(np.repeat(np.frombuffer(f, "<u8"), np.frombuffer(c, "<u2")))
            which.append(np.frombuffer(m, "<u2"))
        fps = np.concatenate(fps)
        variants = fps ^ masks[np.concatenate(which)]
        ordered = np.sort(variants)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(twice):
            return pd.DataFrame({"a": np.array([], np.int64), "b": np.array([], np.int64)})
        near = np.searchsorted(twice, variants)
        hit = twice[np.minimum(near, len(twice) - 1)] == variants
        fps, variants = fps[hit], variants[hit]
        even_variant = np.bitwise_count(variants) & 1 == 0
        centre = (np.bitwise_count(fps) & 1 == 1) == even_variant  # the side that flipped one bit
        order = np.lexsort((fps, ~centre, variants))
        fps, variants, centre = fps[order], variants[order], centre[order]
        first = np.flatnonzero(np.append(True, variants[1:] != variants[:-1]))
        star = np.repeat(first, np.diff(np.append(first, len(variants))))
        a, b = fps, fps[star]
        ok = centre[star] & (a != b)
        ok &= np.bitwise_count(a ^ b) <= radius
        edges = np.unique(np.stack([a[ok], b[ok]], axis=1), axis=0)
        node, root = spanning_forest(edges[:, 0], edges[:, 1])
        return pd.DataFrame({"a": node.view(np.int64), "b": root.view(np.int64)})

    return run


def link_fingerprints(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that keep every component of those
    within ``radius`` bits. The number of buckets follows the number of fingerprints."""
    prepare(distinct.sparkSession)
    n = distinct.count()
    per = ball_masks(radius)[1:]
    buckets = max(1, -(-n * sum(per) // (2 * BUCKET_VARIANTS)))
    # a fingerprint is 8 bytes but hundreds of variants: deal them to as many tasks as there are buckets
    rows = distinct.select("fp").repartition(buckets).mapInArrow(_emit(radius, buckets), "bucket long, fps binary, counts binary, masks binary")
    return rows.groupBy("bucket").applyInPandas(_collide(radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (smallest id reachable by links) of every row.

    Copies meet in one fingerprint first (partial aggregate), so only distinct fingerprints are
    expanded; components are found on fingerprints and joined back to the rows.
    """
    return components(docs, id_col, text_col, words_per_shingle, radius).select("doc_id", "fp", "component_id")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3,
               radius: int = 3, also: tuple[str, ...] = ()) -> DataFrame:
    """:func:`near_duplicates` with ``root``, the smallest fingerprint of the component (components
    of different texts under one id may share their ``component_id``), and the columns ``also``."""
    rows = written(fingerprints(docs, id_col, text_col, words_per_shingle, also), "simhash")
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = connected_components(link_fingerprints(distinct, radius))
    rooted = (distinct.join(roots, F.col("fp") == F.col("node"), "left")
              .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    component = rooted.join(smallest, "root").select(F.col("fp").alias("cfp"), "root", "component_id")
    return rows.join(component, F.col("fp") == F.col("cfp")).select("doc_id", "fp", *also, "root", "component_id")


def hex16(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
