"""SimHash near duplicates by meet-in-the-middle ball hashing (operator 11).

A document's fingerprint has a bit set if over half of its shingles' 64-bit hashes have it.
Two fingerprints link when they differ in at most ``radius`` bits. Then some value lies within
``radius / 2`` bits of both, so every distinct fingerprint emits all its *variants* (itself with
up to ``radius / 2`` bits flipped: 2,081 for radius 4), the shuffle brings equal variants
together, and fingerprints that share one are exactly the linked ones.

*Shuffle on variants.* The space of variants is cut into slices by a linear function over bits:
slice(x ^ mask) = slice(x) ^ slice(mask). A slice that receives a fingerprint can therefore tell
which of its variants belong to it, and all variants that a fingerprint emits into one slice
travel as that one fingerprint (8 bytes, packed). The number of slices follows the number of
distinct fingerprints, so that a slice never holds more than ``SLICE_PRINTS`` of them; inside a
slice, sub-slices by more bits of the same function bound the variants in memory.

*Collisions.* All fingerprints of one variant lie within ``radius`` of each other. The smallest
leads the others (a star, not all pairs), and a pair of leader and member is given out at one of the
many variants that both share only, their *midpoint* (the smaller one with the lower half of the differing
bits flipped): so no pair comes twice, from whatever slices, and a dense group gives a few pairs a
member. No link between components is lost: if another one leads at the midpoint of a linked pair
(x, y), x < y, then it is linked with x and y, and both these pairs come before (x, y) in the order
by the larger member, then the smaller, so that they are connected by induction; if x leads there, the
pair itself is given out.

Equal fingerprints are one node, so copies never meet as pairs. A null or empty text or one
without words has fingerprint zero and links like any other; fewer words than a shingle make
one shingle. Repeated rows are copies. Null ids never become a component's id unless
no member has another one. An empty table gives no rows, extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .components import components

SEED = 42
SLICE_BITS = 8                # 256 slices at least
SLICE_PRINTS = 4 << 20        # fingerprints that a slice receives at most (32 MB); more make more slices
SLICE_VARIANTS = 2 << 20      # variants held at once inside a slice
SEND_PRINTS = 1 << 13         # fingerprints that a sender packs at once (for 256 slices: 2 million of 8 bytes)
CHUNK = 1 << 16               # hashes whose bits are counted at once
U64 = np.uint64


def fingerprint(text: str | None, k: int = 4) -> int:
    """The 64-bit fingerprint of a whole text (A-Z lower-cased, words between ASCII white space)."""
    found = text.encode().lower().split() if text else []
    if not found:
        return 0
    joined = b" ".join(found)
    to = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    at = np.append(0, to[:-1])
    n = max(len(found) - k + 1, 1)
    starts, ends = at[:n].tolist(), (to[min(k, len(found)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), U64, n)
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, CHUNK):
        counts += np.unpackbits(hashes[lo:lo + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(U64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4) -> DataFrame:
    """(id, print): one row per document, the fingerprint as a signed 64-bit integer."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("print", T.LongType())])

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), k) for t in batch.column(1)], dtype=U64)
            yield pa.record_batch([batch.column(0), pa.array(found.view(np.int64))], names=["id", "print"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def ball(half: int) -> np.ndarray:
    """Masks of up to ``half`` flipped bits."""
    return np.array([sum(1 << b for b in bits) for n in range(half + 1) for bits in combinations(range(64), n)], dtype=U64)


def _bit_codes(bits: int) -> list[int]:
    """A ``bits``-bit code for every bit position (a fixed pseudo-random sequence)."""
    return [xxhash.xxh64_intdigest(bytes([b]), 7) & ((1 << bits) - 1) for b in range(64)]


def slice_of(values: np.ndarray, bits: int) -> np.ndarray:
    """The linear slice function: exclusive or of the codes of all set bits."""
    codes, out = _bit_codes(bits), np.zeros(len(values), np.int64)
    for byte in range(8):
        table = np.zeros(256, np.int64)
        for b in range(8):
            table[np.arange(256) >> b & 1 == 1] ^= codes[8 * byte + b]
        out ^= table[(values >> U64(8 * byte) & U64(255)).astype(np.int64)]
    return out


def midpoint(low: np.ndarray, high: np.ndarray, radius: int) -> np.ndarray:
    """``low`` with the lower half (rounded down) of the bits flipped that differ from ``high``: a variant of
    both if they differ in ``radius`` bits at most."""
    rest = low ^ high
    flips, out = np.bitwise_count(rest) // 2, low.copy()
    for i in range(radius // 2):
        lowest = rest & (~rest + U64(1))
        out ^= np.where(flips > i, lowest, U64(0))
        rest = rest ^ lowest
    return out


def meet(prints: np.ndarray, sub: int, bits: int, masks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (leader, member) whose midpoint is among the variants that lie in slice ``sub``."""
    own = slice_of(prints, bits)
    order = np.argsort(own, kind="stable")
    prints, own = prints[order], own[order]
    wanted = slice_of(masks, bits) ^ sub
    lo, hi = np.searchsorted(own, wanted, "left"), np.searchsorted(own, wanted, "right")
    size = hi - lo
    if not size.any():
        return prints[:0], prints[:0]
    at = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
    source = prints[at]
    variants = source ^ np.repeat(masks, size)
    order = np.argsort(variants)
    variants, source = variants[order], source[order]
    again = np.append(variants[1:] == variants[:-1], False)
    shared = again | np.append(False, again[:-1])[:len(again)]
    variants, source = variants[shared], source[shared]
    if not len(variants):
        return source, source
    first = np.flatnonzero(np.append(True, variants[1:] != variants[:-1]))
    leader = np.repeat(np.minimum.reduceat(source, first), np.diff(np.append(first, len(variants))))
    given = (leader != source) & (variants == midpoint(leader, source, radius))
    return leader[given], source[given]


def links(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Linked pairs (a, b) of a table of distinct fingerprints (column ``print``) that connect
    exactly the components of all links. ``radius`` must be even: half of it is a ball."""
    if radius % 2 or radius < 0:
        raise ValueError("the radius must be even")
    masks = ball(radius // 2)
    count = prints.count()
    bits = SLICE_BITS
    while count * min(1 << bits, len(masks)) / (1 << bits) > SLICE_PRINTS and bits < 40:
        bits += 1
    more = 0   # bits of sub-slices: all variants of a slice, on average, over what may be held at once
    while bits < 60 and count * len(masks) / (1 << bits + more) > SLICE_VARIANTS:
        more += 1
    slices = 1 << bits

    def send(batches):
        reach = np.unique(slice_of(masks, bits))   # a fingerprint goes to these slices, seen from its own
        held: list[np.ndarray] = []

        def pack():
            values = np.concatenate(held)
            own = slice_of(values, bits)
            target = (own[:, None] ^ reach[None, :]).ravel()
            order = np.argsort(target, kind="stable")
            target, packed = target[order], np.repeat(values, len(reach))[order]
            cuts = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
            return pa.record_batch([pa.array(target[cuts]), pa.array([x.tobytes() for x in np.split(packed, cuts[1:])], pa.binary())], names=["slice", "prints"])

        room = max(SEND_PRINTS * 256 // len(reach), 1024)
        for batch in batches:
            values = np.asarray(batch.column(0)).view(U64)
            for lo in range(0, len(values), room):
                held.append(values[lo:lo + room])
                if sum(map(len, held)) >= room:
                    yield pack()
                    held.clear()
        if held and sum(map(len, held)):
            yield pack()

    def collide(key, table):
        values = np.frombuffer(b"".join(table.column("prints").to_pylist()), U64)
        found = []
        for i in range(1 << more):   # the slice code is the lower bits of the sub-slice code
            found.append(meet(values, key[0].as_py() | i << bits, bits + more, masks, radius))
        a, b = (np.concatenate(x) for x in zip(*found))
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    sent = prints.select("print").mapInArrow(send, "slice long, prints binary")
    tasks = min(slices, max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count * len(masks) // (64 << 20))))
    return sent.repartition(tasks, "slice").groupBy("slice").applyInArrow(collide, "a long, b long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, radius: int = 4) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``, the
    smallest id reachable by links (itself included)."""
    found = stage(fingerprints(docs, id_col, text_col, k), "prints")
    distinct = stage(found.select("print").distinct(), "distinct-prints")
    joined = stage(components(links(distinct, radius)), "labels")
    lowest = found.groupBy("print").agg(F.min("id").alias("id"))   # partial minima: a frequent fingerprint is one row a task
    placed = stage(lowest.join(joined, lowest["print"] == joined["node"], "left")
                   .select("print", "id", F.coalesce("component", "print").alias("label")), "placed")
    roots = stage(placed.groupBy("label").agg(F.min("id").alias("component_id")), "roots")
    named = stage(placed.join(roots, "label").select("print", "component_id"), "named")   # staged: AQE can split a hot fingerprint
    return (found.join(named, "print")
            .select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"))
