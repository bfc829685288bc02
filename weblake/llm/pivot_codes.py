"""Vector codes by product quantisation with LAESA pivots (operator 12).

A vector's components become integers, the vector is cut into equal parts, and each part
gets the index of the nearest entry of its position's codebook. Codebooks start as parts of
the first vectors and move to the (floored) means of their parts for a fixed number of rounds.

The nearest entry is found by LAESA (linear approximating and eliminating search): a few
entries of the first codebook serve as fixed pivots of their part position. Every part's
distances to them are computed once and stored with the part. A round only computes the
distances from the pivots to its entries; by the triangle inequality their largest difference
bounds the distance of a part and an entry from below. Entries are visited in the order of that
bound, exactly and in integers, until the bound of the next one exceeds the best distance.
Bounds are widened by the rounding error of floats, so pruning never changes a result.

A round is one pass over the stored parts. A task sums its parts by entry, so what it sends on
has the size of the codebooks; the driver holds these alone (entries x components integers).

Rows whose vector is null or holds a null or non-finite component are dropped. Null ids come
last in the order of ids, rows of equal ids are ordered by their vectors; repeated rows count as
often as they occur. The dimension is that of the first row in this order whose vector can
be cut into equal, non-empty parts; vectors of another length keep their row with null code and
error. Null labels are one label. Fewer rows than entries make a smaller codebook; an empty table
gives no rows. Components beyond 2**30 after scaling are refused, as their distances could
leave 64 bits. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage

PIVOTS = 8
BLOCK_ROWS = 2048                 # parts whose bounds are held at once
TILE_ROWS = 128                   # parts that go on together
SPARSE = 8                        # pair by pair where less than this part of a step is left
STEP = 128                        # entries that a tile meets before bounds are compared again
COMPONENT_LIMIT = 1 << 30


@dataclass
class Codes:
    """``rows`` (id, label, code, error) and the final codebooks (one integer array per part)."""
    rows: DataFrame
    codebooks: list[np.ndarray]

    def sha256(self) -> str:
        """Digest of all entries' components by part, entry and position."""
        return hashlib.sha256(",".join(str(x) for book in self.codebooks for x in book.ravel().tolist()).encode()).hexdigest()


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` and ``b`` (pair by pair, or broadcast), in integers of
    the operands' width (see :func:`narrow`), 64 bits unless both are 32."""
    gap = a - b
    return np.einsum("...i,...i->...", gap, gap)


def narrow(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in 32-bit integers where no squared distance can leave them, else in 64 bits."""
    top = max(int(np.abs(rows).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.int32 if 4 * top * top * max(rows.shape[1], 1) < 1 << 31 else np.int64
    return rows.astype(kind), book.astype(kind)


def choose_pivots(book: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Entries far from each other: the first, then always the one farthest from those chosen."""
    chosen = [0] if len(book) else []
    near = distances(book, book[0]) if len(book) else None
    while chosen and len(chosen) < count and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(book, book[chosen[-1]]))
    return book[chosen]


def pivot_distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances (not squared) of every row to every pivot."""
    return np.stack([np.sqrt(distances(rows, p).astype(np.float64)) for p in pivots], axis=1) if len(pivots) else np.zeros((len(rows), 0))


def _float_type(rows_norm: int, book_norm: int):
    """The narrowest float in which ``|e|^2 - 2xe`` is exact (all its partial sums are integers below
    the mantissa's limit, by Cauchy-Schwarz), or None."""
    top = book_norm + 2 * (math.isqrt(rows_norm * book_norm) + 1)
    return np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else None


def nearest(rows: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, book_to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of every row's nearest entry (ties: the lower index), and how
    many exact distances it took.

    A row first meets the entry of its lowest bound. Rows that met the same one then go on together
    in tiles: entries in the order of the tile's lowest bounds, ``STEP`` at a time, and before each
    step those that no row's bound allows any more are dropped. Where bounds rule out most of a
    step its distances are computed pair by pair, else as a matrix product in floats, in which these
    integers are exact; neither changes a result."""
    index, best, evaluated = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), 0
    entries = len(book)
    rows, book = narrow(rows, book)
    rows_norm, book_norm = (np.einsum("ij,ij->i", x, x, dtype=np.int64) for x in (rows, book))
    kind = _float_type(int(rows_norm.max(initial=0)), int(book_norm.max(initial=0)))
    if kind:
        rows_float, book_float, norm_float = rows.astype(kind), -2 * book.astype(kind).T, book_norm.astype(kind)
    to_book = np.ascontiguousarray(book_to_pivots.T.astype(np.float32))

    def lowest(at: np.ndarray, cols: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Least squared distance of each of the rows to the allowed of the entries, its entry (the
        first among equals), and the number of distances computed."""
        row, col = np.nonzero(allowed) if not kind or np.count_nonzero(allowed) < allowed.size // SPARSE else (None, None)
        if row is None:
            found = rows_float[at] @ book_float[:, cols] + norm_float[cols]
            least = found.argmin(axis=1)
            return found[np.arange(len(at)), least].astype(np.int64) + rows_norm[at], cols[least], found.size
        found = np.full(allowed.shape, np.iinfo(np.int64).max)
        found[row, col] = distances(rows[at[row]], book[cols[col]])
        least = found.argmin(axis=1)
        return found[np.arange(len(at)), least], cols[least], len(row)

    for lo in range(0, len(rows), BLOCK_ROWS):
        at_rows = np.arange(lo, min(lo + BLOCK_ROWS, len(rows)))
        own = to_pivots[at_rows].astype(np.float32)
        bound, gap = np.zeros((len(own), entries), np.float32), np.empty((len(own), entries), np.float32)
        for j in range(own.shape[1]):
            np.subtract(own[:, j:j + 1], to_book[j], out=gap)
            np.maximum(bound, np.abs(gap, out=gap), out=bound)
        slack = 2e-6 * (own.max(initial=0.0) + to_book.max(initial=0.0)) + 1e-6   # distances and bounds are 32-bit floats
        chosen = bound.argmin(axis=1)
        key = distances(rows[at_rows], book[chosen]).astype(np.int64)
        evaluated += len(key)
        together = np.argsort(chosen, kind="stable")
        for tile in np.split(together, range(TILE_ROWS, len(together), TILE_ROWS)):
            near = bound[tile]
            low = near.min(axis=0)
            order = np.argsort(low)
            for step in range(0, entries, STEP):
                reach = np.sqrt(key[tile].astype(np.float64)) * (1 + 1e-6) + slack
                cols = order[step:step + STEP]
                if low[cols[0]] > reach.max():
                    break
                allowed = near[:, cols] <= reach[:, None].astype(np.float32)
                some = allowed.any(axis=0)
                if not some.any():
                    continue
                cols, allowed = cols[some], allowed[:, some]
                by_index = np.argsort(cols)   # the lower index comes first among equals
                value, entry, count = lowest(at_rows[tile], cols[by_index], allowed[:, by_index])
                evaluated += count
                better = (value < key[tile]) | ((value == key[tile]) & (entry < chosen[tile]))
                key[tile[better]], chosen[tile[better]] = value[better], entry[better]
        index[at_rows], best[at_rows] = chosen, key
    return index, best, evaluated


def means(book: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Entries moved to the floored means of their parts; unused ones stay."""
    return np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], book)


def _integers(vectors: pa.Array, dims: int, scale: int) -> np.ndarray:
    flat = np.floor(np.asarray(vectors.flatten(), dtype=np.float64) * scale)
    if len(flat) and np.abs(flat).max() > COMPONENT_LIMIT:
        raise OverflowError(f"a vector component exceeds {COMPONENT_LIMIT} after scaling")
    return flat.astype(np.int64).reshape(-1, dims)


def _parts(table, parts: int, dims: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Parts and their pivot distances of a batch of stored rows."""
    n = table.num_rows
    whole = np.asarray(table.column("ints").flatten(), dtype=np.int64).reshape(n, dims)
    far = np.asarray(table.column("far").flatten(), dtype=np.float32)
    far = far.reshape(n, parts, -1) if len(far) else np.zeros((n, parts, 0), np.float32)
    return np.split(whole, parts, axis=1), [far[:, p] for p in range(parts)]


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> Codes:
    """Learn the codebooks on all rows and encode them."""
    spark, schema = vectors.sparkSession, vectors.schema
    id_field, label_field = T.StructField("id", schema[id_col].dataType), T.StructField("label", schema[label_col].dataType)
    out_schema = T.StructType([id_field, label_field, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec")).where(F.col("vec").isNotNull() & fine)
    order = [F.col("id").isNull(), F.col("id"), F.col("vec")]
    whole = kept.where((F.size("vec") > 0) & (F.size("vec") % parts == 0))
    top = whole.orderBy(*order).select(F.size("vec")).first()
    if top is None:   # nothing that could be cut into parts
        return Codes(kept.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")),
                     [np.zeros((0, 0), np.int64)] * parts)
    dims = top[0]
    same = F.size("vec") == dims
    first = whole.where(same).orderBy(*order).limit(entries).select("vec").toArrow()   # at most ``entries`` rows
    books = np.split(_integers(first.column("vec").combine_chunks(), dims, scale), parts, axis=1)
    pivots = [choose_pivots(book) for book in books]
    width = max(len(p) for p in pivots)
    pivots = [np.concatenate([p, np.repeat(p[:1], width - len(p), axis=0)]) for p in pivots]   # a repeated pivot does no harm

    def store(batches):
        for batch in batches:
            ints = _integers(batch.column(2), dims, scale)
            far = np.stack([pivot_distances(x, p) for x, p in zip(np.split(ints, parts, axis=1), pivots)], axis=1).astype(np.float32)
            n = batch.num_rows
            yield pa.record_batch([batch.column(0), batch.column(1),
                                   pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * dims, pa.array(ints.ravel().astype(np.int32))),
                                   pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * (parts * width), pa.array(far.ravel()))],
                                  names=["id", "label", "ints", "far"])

    stored_schema = T.StructType([id_field, label_field, T.StructField("ints", T.ArrayType(T.IntegerType())), T.StructField("far", T.ArrayType(T.FloatType()))])
    stored = stage(kept.where(same).mapInArrow(store, stored_schema), "parts")

    def summed(books, far):
        def run(batches):
            counts = [np.zeros(len(b), np.int64) for b in books]
            sums = [np.zeros(b.shape, np.int64) for b in books]
            for batch in batches:
                for p, (x, d) in enumerate(zip(*_parts(batch, parts, dims))):
                    index, _, _ = nearest(x, d, books[p], far[p])
                    counts[p] += np.bincount(index, minlength=len(books[p]))
                    used, where = np.unique(index, return_inverse=True)
                    by = np.argsort(where, kind="stable")
                    if len(by):
                        sums[p][used] += np.add.reduceat(x[by], np.searchsorted(where[by], np.arange(len(used))), axis=0)
            for p in range(parts):   # position -1 holds the counts
                table = np.concatenate([counts[p][:, None], sums[p]], axis=1)
                entry, at = np.nonzero(np.repeat(counts[p][:, None] > 0, table.shape[1], axis=1))
                yield pa.record_batch([pa.array(np.full(len(entry), p, np.int32)), pa.array(entry.astype(np.int32)), pa.array((at - 1).astype(np.int32)),
                                       pa.array(table[entry, at])], names=["part", "entry", "at", "total"])
        return run

    for _ in range(rounds):
        far = [pivot_distances(b, p) for b, p in zip(books, pivots)]
        total = (stored.select("ints", "far").mapInArrow(summed(books, far), "part int, entry int, at int, total long")
                 .groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).toArrow())   # at most entries x (dims + parts) rows
        part, entry, at, value = (np.asarray(total.column(c)) for c in ("part", "entry", "at", "total"))
        moved = []
        for p, book in enumerate(books):
            grid = np.zeros((len(book), book.shape[1] + 1), np.int64)
            mine = part == p
            grid[entry[mine], at[mine] + 1] = value[mine]
            moved.append(means(book, grid[:, 0], grid[:, 1:]))
        books = moved

    far = [pivot_distances(b, p) for b, p in zip(books, pivots)]

    def encode(batches):
        for batch in batches:
            digits, error = np.zeros((batch.num_rows, parts), np.int64), np.zeros(batch.num_rows, np.int64)
            for p, (x, d) in enumerate(zip(*_parts(batch, parts, dims))):
                digits[:, p], least, _ = nearest(x, d, books[p], far[p])
                error += least
            code = ["".join(f"{i:02x}" for i in row) for row in digits.tolist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error)], names=["id", "label", "code", "error"])

    coded = stored.mapInArrow(encode, out_schema)
    odd = kept.where(~same).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return Codes(stage(coded.unionByName(odd), "codes"), books)


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` with the error summed over all rows of their label (nulls are one label). The
    sums are staged, so that adaptive execution can split the rows of a frequent label."""
    key = F.struct(F.col("label").isNull().alias("none"), F.col("label").cast("string").alias("text"))
    named = rows.withColumn("__label", F.to_json(key))
    sums = stage(named.groupBy("__label").agg(F.sum("error").alias("label_error")), "label-errors")
    return named.join(sums, "__label").drop("__label")
