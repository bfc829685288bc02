"""Jaccard join of word n-gram sets by vertical partitioning (operator 9).

A document's set holds the distinct ``k``-word shingles of its whole text; one with fewer
words, but some, has its whole word sequence as its only shingle. Two documents link when
``100 * |intersection| >= percent * |union|``.

The global n-gram order is cut into fragments, every document's set into the matching
segments, overlaps are counted separately in each fragment and summed:

1. *Fingerprints.* One pass gives each document its set's size and a 64-bit signature;
   equal sets are one class, so exact copies never meet as pairs. Different sets that share a
   signature are told apart by a second one: classes are equal in 128 bits. The same pass
   reports n-grams that are common inside one block of text.
2. *Support.* Segments go to their fragments (the number of fragments follows the text
   bytes, so a fragment's size does not grow). A fragment counts in how many classes each
   of its n-grams lies; the partial counts of shared n-grams are summed per class. A class
   can only link if ``|shared| >= percent/100 * |set|``: on prose this leaves the near
   copies and little else. Common n-grams are known to be shared and skip their fragment,
   so no fragment has to hold the documents of a hot passage; which n-grams count as
   common (at most ``HOT_LIMIT``, most frequent first) moves work, never results. (An n-gram spread
   so thinly that no block of text holds ``HOT_LOCAL`` of its documents is not seen as common.)
3. *Candidates.* N-grams are ordered by document frequency, then hash. Similar sets share
   an n-gram within their prefixes, at positions that leave room for the overlap needed.
   First every class meets one leader per prefix n-gram; then, with the components of
   those links known, classes of different components that share a prefix n-gram meet.
   The members of one component of near copies are therefore never paired with each other.
4. *Overlaps.* Each candidate pair's overlap is counted fragment by fragment and the
   partial counts are summed per pair; the threshold decides on the exact total.

Null and empty texts (or texts without words) have an empty set and link with nothing;
their component is their own id. Repeated rows are copies of each other. Null ids never
become a component's id unless no other member has one. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .components import components
from .words import PLAIN_WORD, U64, blocks, mix, split, windows

FRAGMENT_BYTES = 16 << 20   # text bytes whose n-grams make one fragment
HOT_LOCAL = 8               # documents of one block (some hundreds) that make an n-gram common there
HOT_LIMIT = 250_000         # common n-grams kept (2 MB broadcast at most)
BLOCK = 2 << 20
PIECES = 8                  # fragments of the candidates' overlap count

SEGMENT_ROW = "part int, sig binary, n binary, len binary, hash binary, df binary"
SEGMENT_ARROW = pa.schema([("part", pa.int32())] + [(c, pa.binary()) for c in ("sig", "n", "len", "hash", "df")])


def shingle_sets(texts: pa.Array, k: int):
    """For each block: (first row, distinct sorted shingle hashes, row bounds).

    Hashes keep 48 bits: two sets of a thousand n-grams share a false one with a chance of
    about 4e-9, and every hash costs six bytes in the shuffles instead of eight."""
    for block in blocks(texts, BLOCK):
        hashes, bounds = windows(split(block, PLAIN_WORD, lower=True), k)
        hashes &= U64(0xFFFFFFFFFFFF0000)
        for at, to in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            hashes[at:to].sort()
        keep = np.ones(len(hashes), dtype=bool)
        keep[1:] = hashes[1:] != hashes[:-1]
        keep[bounds[:-1][np.diff(bounds) > 0]] = True
        kept = np.zeros(len(hashes) + 1, dtype=np.int64)
        np.cumsum(keep, out=kept[1:])
        yield block.lo, hashes[keep], kept[bounds]


def signatures(hashes: np.ndarray, bounds: np.ndarray, second: bool = False) -> np.ndarray:
    """A 64-bit signature of every set (order-free sum of mixed hashes, and the size); ``second``
    gives another one, independent of the first."""
    seed, factor = (U64(0xA24BAED4963EE407), U64(0xD6E8FEB86659FD93)) if second else (U64(0x5851F42D4C957F2D), U64(0x9E3779B97F4A7C15))
    sums = np.zeros(len(hashes) + 1, dtype=U64)
    np.cumsum(mix(hashes ^ seed), out=sums[1:])
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(U64) * factor).view(np.int64)


def _fingerprints(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Rows of documents (id, n, sig, second) and of locally common n-grams (hot, hits)."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("n", T.LongType()), T.StructField("sig", T.LongType()),
                           T.StructField("second", T.LongType()), T.StructField("hot", T.LongType()), T.StructField("hits", T.LongType())])

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hashes, bounds in shingle_sets(batch.column(1), k):
                n = np.diff(bounds)
                sig = signatures(hashes, bounds)
                rows = len(n)
                second = signatures(hashes, bounds, second=True)
                yield pa.record_batch([ids.slice(lo, rows), pa.array(n), pa.array(sig), pa.array(second), pa.nulls(rows, pa.int64()),
                                       pa.nulls(rows, pa.int64())], names=["id", "n", "sig", "second", "hot", "hits"])
                _, first = np.unique(sig, return_index=True)  # copies count once
                once = np.zeros(rows, dtype=bool)
                once[first] = True
                own = np.sort(hashes[np.repeat(once, n)])
                ends = np.flatnonzero(np.append(own[1:] != own[:-1], True)[:len(own)]) + 1
                hits = np.diff(ends, prepend=0)
                common = hits >= HOT_LOCAL
                if common.any():
                    hot = own[ends[common] - 1].view(np.int64)
                    gap = pa.nulls(len(hot), pa.int64())
                    yield pa.record_batch([pa.nulls(len(hot), ids.type), gap, gap, gap, pa.array(hot), pa.array(hits[common])],
                                          names=["id", "n", "sig", "second", "hot", "hits"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _wire(hashes: np.ndarray) -> bytes:
    """The upper 48 bits, which is all that n-gram hashes have here (see ``shingle_sets``)."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _unwire(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    out[:, 2:] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1).astype(U64, copy=False)


def _pack(part, sig, n, hashes, df=None):
    """Rows of one table of segments from element arrays sorted by (part, sig)."""
    if not len(part):
        return None
    new = np.ones(len(part), dtype=bool)
    new[1:] = (part[1:] != part[:-1]) | (sig[1:] != sig[:-1])
    first = np.flatnonzero(new)
    lens = np.diff(np.append(first, len(part))).astype(np.uint32)
    sigs, ns = sig[first], n[first].astype(np.uint32)
    cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    ends = np.append(cuts[1:], len(part))
    run_at = np.searchsorted(first, cuts)
    run_to = np.append(run_at[1:], len(first))
    cols = [pa.array(part[cuts].astype(np.int32)),
            pa.array([sigs[a:b].tobytes() for a, b in zip(run_at, run_to)], pa.binary()),
            pa.array([ns[a:b].tobytes() for a, b in zip(run_at, run_to)], pa.binary()),
            pa.array([lens[a:b].tobytes() for a, b in zip(run_at, run_to)], pa.binary()),
            pa.array([_wire(hashes[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
            pa.array([df[a:b].tobytes() if df is not None else b"" for a, b in zip(cuts, ends)], pa.binary())]
    return pa.record_batch(cols, schema=SEGMENT_ARROW)


def _unpack(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Element arrays (sig, n, hash, df) of segment rows."""
    def raw(name):
        return b"".join(table.column(name).to_pylist())
    lens = np.frombuffer(raw("len"), dtype=np.uint32)
    return (np.repeat(np.frombuffer(raw("sig"), dtype=np.int64), lens), np.repeat(np.frombuffer(raw("n"), dtype=np.uint32), lens),
            _unwire(raw("hash")), np.frombuffer(raw("df"), dtype=np.uint16))


def _bucket(sig: np.ndarray, count: int) -> np.ndarray:
    return ((mix(sig.view(U64)) >> U64(32)) * U64(count) >> U64(32)).astype(np.int64)


def _segments(docs: DataFrame, text_col: str, k: int, fragments: int, hot, clashes: np.ndarray) -> DataFrame:
    """Every block's segments by fragment; common n-grams go to ``fragments + bucket`` at once."""
    def run(batches):
        common = hot.value
        for batch in batches:
            for _, hashes, bounds in shingle_sets(batch.column(0), k):
                n = np.diff(bounds)
                sig = signatures(hashes, bounds)
                clash = np.isin(sig, clashes)
                if clash.any():
                    sig[clash] = signatures(hashes, bounds, second=True)[clash]
                _, first = np.unique(sig, return_index=True)
                once = np.zeros(len(n), dtype=bool)
                once[first] = True
                mine = np.repeat(once, n)
                hashes, sig, size = hashes[mine], np.repeat(sig, n)[mine], np.repeat(n, n)[mine]
                part = (((hashes >> U64(32)) * U64(fragments)) >> U64(32)).astype(np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
                    known = common[at] == hashes
                    part[known] = fragments + _bucket(sig[known], fragments)
                order = np.argsort(part, kind="stable")  # rows stay together inside a part
                out = _pack(part[order], sig[order], size[order], hashes[order])
                if out is not None:
                    yield out

    return docs.select(text_col).mapInArrow(run, SEGMENT_ROW)


def _several(sig: np.ndarray, n: np.ndarray, hashes: np.ndarray):
    """The elements whose n-gram lies in more than one class, with the n-gram's count (two bytes)."""
    order = np.argsort(hashes)
    sig, n, hashes = sig[order], n[order], hashes[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[:len(hashes)])
    size = np.diff(np.append(first, len(hashes)))
    shared = np.minimum.reduceat(sig, first) != np.maximum.reduceat(sig, first) if len(first) else np.zeros(0, bool)
    keep = np.repeat(shared, size)
    return sig[keep], n[keep], hashes[keep], np.repeat(np.minimum(size[shared], 0xFFFE), size[shared]).astype(np.uint16)


def _shared(segments: DataFrame, fragments: int) -> DataFrame:
    """Per fragment: the n-grams of more than one class, with that count, by class bucket."""
    def run(key, table):
        part = key[0].as_py()
        sig, n, hashes, _ = _unpack(table)
        if part >= fragments:
            df, bucket = np.full(len(sig), 0xFFFF, dtype=np.uint16), np.full(len(sig), part - fragments, dtype=np.int64)
        else:
            eighth = (hashes >> U64(20)).astype(np.uint8) & 7   # an eighth of the n-grams at a time, to hold less
            found = [_several(sig[q], n[q], hashes[q]) for q in (np.flatnonzero(eighth == i) for i in range(8))]
            sig, n, hashes, df = (np.concatenate(x) for x in zip(*found))
            bucket = _bucket(sig, fragments)
        order = np.lexsort((hashes, sig, bucket))
        out = _pack(bucket[order], sig[order], n[order], hashes[order], df[order])
        return pa.Table.from_batches([out] if out is not None else [], SEGMENT_ARROW)

    return segments.groupBy("part").applyInArrow(run, SEGMENT_ROW)


CLASS_ROW = "sig bigint, n bigint, shared bigint, prefix array<bigint>, pieces array<array<bigint>>"
CLASS_ARROW = pa.schema([("sig", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("prefix", pa.list_(pa.int64())),
                         ("pieces", pa.list_(pa.list_(pa.int64())))])


def _supported(shared: DataFrame, percent: int) -> DataFrame:
    """Classes with enough shared n-grams: their prefix in the global order and their pieces."""
    def run(table):
        sig, n, hashes, df = _unpack(table)
        order = np.lexsort((hashes, sig))
        sig, n, hashes, df = sig[order], n[order].astype(np.int64), hashes[order], df[order]
        keep = np.ones(len(sig), dtype=bool)
        keep[1:] = (sig[1:] != sig[:-1]) | (hashes[1:] != hashes[:-1])  # copies of other blocks
        sig, n, hashes, df = sig[keep], n[keep], hashes[keep], df[keep]
        first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(sig)).astype(np.int64)
        rows = []
        for a, b in zip(first.tolist(), ends.tolist()):
            need = (percent * int(n[a]) + 99) // 100
            if b - a < need:
                continue
            own, rank = hashes[a:b], df[a:b]
            prefix = own[np.lexsort((own, rank))][:b - a - need + 1]
            cuts = np.searchsorted(own, (np.arange(1, PIECES, dtype=U64) << U64(61)))
            rows.append({"sig": int(sig[a]), "n": int(n[a]), "shared": b - a, "prefix": prefix.view(np.int64),
                         "pieces": np.split(own.view(np.int64), cuts)})
        return pa.Table.from_pylist(rows, CLASS_ARROW)

    return shared.groupBy("part").applyInArrow(run, CLASS_ROW)


def _fits(percent: int, n1, rem1, n2, rem2):
    """The n-grams left from both positions on leave room for the overlap needed."""
    return (F.lit(100 + percent) * F.least(rem1, rem2)) >= F.lit(percent) * (n1 + n2)


def _links(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) at the threshold: partial overlaps by fragment, summed per pair."""
    piece = classes.select("sig", "n", F.posexplode("pieces").alias("piece", "own"))
    one = piece.select(F.col("sig").alias("a"), F.col("n").alias("na"), "piece", F.col("own").alias("own_a"))
    two = piece.select(F.col("sig").alias("b"), F.col("n").alias("nb"), "piece", F.col("own").alias("own_b"))
    partial = (pairs.join(one, "a").join(two, ["b", "piece"])
               .select("a", "b", "na", "nb", F.size(F.array_intersect("own_a", "own_b")).alias("partial")))
    return (partial.groupBy("a", "b", "na", "nb").agg(F.sum("partial").alias("overlap"))
            .where(F.lit(100) * F.col("overlap") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("overlap")))
            .select("a", "b", "overlap"))


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """(documents: id, n, sig; labels: sig, label) -- documents with equal ``label`` (``sig``
    where a class has none) are in one component of the links."""
    spark = docs.sparkSession
    prints = stage(_fingerprints(docs, id_col, text_col, k), "prints")
    # different sets with one signature: about n^2 / 2^65 of n documents (70 of 5e10)
    clashes = (prints.where("sig is not null").groupBy("sig").agg(F.min("second").alias("low"), F.max("second").alias("high"))
               .where("low <> high").select("sig").toArrow().column(0).to_numpy().astype(np.int64))
    members = prints.where("sig is not null").select(
        "id", "n", F.when(F.col("sig").isin(clashes.tolist()), F.col("second")).otherwise(F.col("sig")).alias("sig"))
    hot = (prints.where("hot is not null").groupBy("hot").agg(F.sum("hits").alias("hits"))
           .orderBy(F.desc("hits"), "hot").limit(HOT_LIMIT).select("hot").toArrow().column(0).to_numpy())
    common = spark.sparkContext.broadcast(np.sort(hot.astype(np.int64).view(U64)))
    text_bytes = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    fragments = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes // FRAGMENT_BYTES))

    shared = _shared(_segments(docs, text_col, k, fragments, common, clashes), fragments)
    classes = stage(_supported(shared, percent), "classes")

    first = (classes.select("sig", "n", "shared", F.posexplode("prefix").alias("at", "gram"))
             .select("gram", "sig", "n", (F.col("shared") - F.col("at")).alias("rem")))
    # the leader is the class that has the n-gram earliest for its size: in a group of near
    # copies that is the text the others were made from, which links with most of them
    # staged, like every aggregate that is joined on its own key here: AQE can then split a hot n-gram
    lead = stage(first.groupBy("gram").agg(F.min(F.struct((F.lit(1) - F.col("rem") / F.col("n")).alias("at"), "sig", "n", "rem")).alias("lead"),
                                      F.count(F.lit(1)).alias("df"))
            .where("df > 1").select("gram", "lead.sig", "lead.n", "lead.rem").toDF("gram", "lead", "lead_n", "lead_rem"), "leaders")
    met = first.join(lead, "gram").where((F.col("sig") != F.col("lead"))
                                         & _fits(percent, F.col("n"), F.col("rem"), F.col("lead_n"), F.col("lead_rem")))
    links = stage(_links(_pairs(met, "sig", "lead"), classes, percent), "links")
    known = stage(components(links).select(F.col("node").alias("sig"), F.col("component").alias("label")), "labels")

    mine = (first.join(known, "sig", "left").select("gram", "sig", "n", "rem", F.coalesce("label", "sig").alias("label")))
    sides = mine.groupBy("gram", "label").agg(F.count(F.lit(1)).alias("size"))
    # ties go to the larger label: both sides of the join below must name the same main label
    split_up = stage(sides.groupBy("gram").agg(F.max(F.struct("size", "label"))["label"].alias("main"), F.count(F.lit(1)).alias("labels"))
                .where("labels > 1").select("gram", "main"), "split-up")
    mixed = mine.join(split_up, "gram")
    other = mixed.where("label != main").select("gram", F.col("sig").alias("sig2"), F.col("n").alias("n2"),
                                                F.col("rem").alias("rem2"), F.col("label").alias("label2"))
    meet = mixed.join(other, "gram").where(
        (F.col("label") != F.col("label2")) & ((F.col("label") == F.col("main")) | (F.col("sig") < F.col("sig2")))
        & _fits(percent, F.col("n"), F.col("rem"), F.col("n2"), F.col("rem2")))
    more = stage(_links(_pairs(meet, "sig", "sig2"), classes, percent), "links")
    joined = components(links.unionByName(more))
    return members, joined.select(F.col("node").alias("sig"), F.col("component").alias("label"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       percent: int = 75) -> DataFrame:
    """One row per document: its id, ``n_shingles`` and ``component_id``, the smallest id
    reachable by links (itself included)."""
    members, labels = jaccard_classes(docs, id_col, text_col, k, percent)
    labels = stage(labels, "labels")
    placed = members.where("n > 0").join(labels, "sig", "left").select("id", "n", F.coalesce("label", "sig").alias("label"))
    roots = stage(placed.groupBy("label").agg(F.min("id").alias("component_id")), "roots")   # staged: AQE can then split a hot label
    linked = placed.join(roots, "label").select("id", "n", "component_id")
    alone = members.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                      percent: int = 75) -> DataFrame:
    """The documents' rows with one row of each component kept: the smallest id (null ids come
    last), then the smallest text hash; of rows equal in both, the one whose columns (maps aside) hash lowest.

    Rows are told apart by id and text hash. The set of kept rows grows with the corpus, so it
    is never broadcast: one sort-merge join moves the texts, at every size, and the choice among
    equal rows needs no further shuffle."""
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    row = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), text_hash.alias("hash"))
    found = jaccard_components(docs.select(row.alias("row"), F.col(text_col).alias("text")), "row", "text", k, percent)

    def name(of):
        return F.coalesce(of.cast("string"), F.lit("\0"))

    kept = (found.where(F.col("row") == F.col("component_id"))
            .select(name(F.col("row.id")).alias("__id"), F.col("row.hash").alias("__hash")).distinct())
    chosen = docs.withColumns({"__id": name(F.col(id_col)), "__hash": text_hash}).join(kept.hint("merge"), ["__id", "__hash"])
    whole = F.xxhash64(*[F.col(f.name) for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)])
    first = F.row_number().over(Window.partitionBy("__id", "__hash").orderBy(whole, F.col(text_col).isNull()))
    return chosen.withColumn("__copy", first).where("__copy = 1").select(*docs.columns)
