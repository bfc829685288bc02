"""Benchmark decontamination by Wu-Manber multi-pattern search over words (operator 3).

Every window of ``window`` consecutive words of a benchmark item is a pattern; an item of
fewer words, but some, is one pattern. Patterns of one length share a matcher:

* the *shift table* maps the hash of a block of two words to how far a window that ends
  with this block may move before any pattern could end there, so most positions are
  never looked at;
* where the shift is zero, the block's *suffix bucket* selects the patterns that end so;
* word hashes of the whole window are compared, and then the words themselves.

A block of documents is searched in lanes (stretches of a document that overlap by one
window), all lanes moving by their own shifts at once. Patterns are positions in the items'
words, which they share, equal ones once; the tables take some 30 bytes a benchmark word
(about 50 MB for the 8 MB chunk). The benchmark's distinct rows are broadcast in chunks of about
``CHUNK_BYTES`` of text (an item is not cut). A larger benchmark takes more passes over the
documents: each writes the few rows that it found, so that one chunk is resident at a time.

A document word inside any occurrence is hit. A document is contaminated if it has a hit
and hit words make at least ``1/ratio`` of its words. Null and empty texts have no words
and no hits, null or empty items no patterns; repeated rows are judged each for itself;
repeated item ids count once; null item ids are left out of the item list, not of the
hits; empty tables work; other columns pass through.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .words import ALNUM_WORD, LOWER, U64, Block, Words, blocks, mix, span_hashes, split

CHUNK_BYTES = 8 << 20
LANE = 1024
_PAIR = U64(0xA24BAED4963EE407)
_EMPTY = np.zeros(0, dtype=np.int64)


def _expand(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``begin : begin + size``."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(begins - ends + sizes, sizes)


class Matcher:
    """Wu-Manber tables of the patterns of one length.

    ``words`` are the benchmark's words over their bytes ``data`` (with ``ids`` that are equal for equal
    words), ``first`` the patterns' first words and ``owner`` their items (numbers in ``names``; -1: none)."""

    def __init__(self, data: np.ndarray, words: Words, ids: np.ndarray, first: np.ndarray, owner: np.ndarray, names: list[str], length: int):
        self.length, self.names, self.data = length, names, data
        self.starts, self.ends, self.hashes = words.starts.astype(np.int32), words.ends.astype(np.int32), words.hashes
        key = np.zeros(len(first), dtype=U64)
        for j in range(length):
            key = mix(key * _PAIR + self.hashes[first + j])
        order = np.argsort(key, kind="stable")
        key, first = key[order], first[order]
        new = np.append(True, key[1:] != key[:-1])   # equal windows are one pattern
        for j in range(length):
            new[1:] |= ids[first[1:] + j] != ids[first[:-1] + j]
        self.first = first[new].astype(np.int32)
        self.owner, self.owner_bounds = owner[order].astype(np.int32), np.append(np.flatnonzero(new), len(first)).astype(np.int32)
        self.width = min(2, length)
        self.bits = max(10, int(np.ceil(np.log2(4 * len(ids) + 1))))
        self.shift = np.full(1 << self.bits, length - self.width + 1, dtype=np.min_scalar_type(length))
        for end in range(self.width - 1, length):
            np.minimum.at(self.shift, self._ending(end), self.shift.dtype.type(length - 1 - end))
        suffix = self._ending(length - 1)
        self.order = np.argsort(suffix, kind="stable").astype(np.int32)
        self.suffix = suffix[self.order].astype(np.int32 if self.bits < 32 else np.int64)

    def _ending(self, end: int) -> np.ndarray:
        """The slot of every pattern's block that ends with its word ``end``."""
        return self.slots(self.hashes[self.first + end - 1] if self.width == 2 else None, self.hashes[self.first + end])

    @property
    def nbytes(self) -> int:
        """Bytes of all tables (the words are shared between the matchers of one chunk)."""
        return sum(v.nbytes for v in vars(self).values() if isinstance(v, np.ndarray))

    def items(self, pattern: int) -> list[str]:
        own = self.owner[self.owner_bounds[pattern]:self.owner_bounds[pattern + 1]]
        return [self.names[i] for i in set(own.tolist()) if i >= 0]

    def slots(self, before, last) -> np.ndarray:
        key = last if before is None else before * _PAIR + last
        return (mix(key) >> U64(64 - self.bits)).astype(np.int64)

    def _candidates(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(end position, slot) wherever the shift is zero."""
        m, h = self.length, words.hashes
        ends = np.maximum(words.counts - m + 1, 0)     # possible window ends of each row
        lanes = -(-ends // LANE)
        at = np.repeat(words.bounds[:-1] + m - 1, lanes) + LANE * _expand(np.zeros(len(lanes), np.int64), lanes)
        to = np.minimum(at + LANE, np.repeat(words.bounds[1:], lanes))
        found, where = [], []
        while len(at):
            slot = self.slots(h[at - 1] if self.width == 2 else None, h[at])
            move = self.shift[slot].astype(np.int64)
            stop = move == 0
            if stop.any():
                found.append(at[stop])
                where.append(slot[stop])
            at = at + np.maximum(move, 1)
            on = at < to
            at, to = at[on], to[on]
        return (np.concatenate(found), np.concatenate(where)) if found else (_EMPTY, _EMPTY)

    def search(self, data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern number of every occurrence."""
        end, slot = self._candidates(words)
        low = np.searchsorted(self.suffix, slot, "left")
        size = np.searchsorted(self.suffix, slot, "right") - low
        pattern = self.order[_expand(low, size)]
        first = np.repeat(end, size) - self.length + 1
        for j in range(self.length):   # prefix first; most wrong ones fall out at once
            same = words.hashes[first + j] == self.hashes[self.first[pattern] + j]
            first, pattern = first[same], pattern[same]
        right = np.zeros(len(first), dtype=bool)
        for i, (at, own) in enumerate(zip(first.tolist(), self.first[pattern].tolist())):
            right[i] = all(data[words.starts[at + j]:words.ends[at + j]].tobytes() == self.data[self.starts[own + j]:self.ends[own + j]].tobytes()
                           for j in range(self.length))
        return first[right], pattern[right]


def build(items: list[tuple], window: int) -> list[Matcher]:
    """Matchers of (item id, text) rows, one for each pattern length."""
    texts = pa.array([t for _, t in items], pa.string())
    whole = next(blocks(texts, limit=1 << 62), None)
    if whole is None:
        return []
    words, data = split(whole, ALNUM_WORD, lower=True), LOWER[whole.data]
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(data[a:b].tobytes(), len(known)) for a, b in zip(words.starts.tolist(), words.ends.tolist())], dtype=np.int32)
    names = sorted({str(i) for i, _ in items if i is not None})
    number = {n: k for k, n in enumerate(names)}
    owner = np.array([-1 if i is None else number[str(i)] for i, _ in items], dtype=np.int32)
    counts = words.counts
    windows = np.where(counts > 0, np.maximum(counts - window, 0) + 1, 0)
    first = _expand(words.bounds[:-1], windows)
    length, owner = np.repeat(np.minimum(counts, window), windows), np.repeat(owner, windows)
    return [Matcher(data, words, ids, first[length == m], owner[length == m], names, int(m)) for m in np.unique(length)]


def search_block(block: Block, matchers: list[Matcher]) -> tuple[Words, np.ndarray, np.ndarray, list[set]]:
    """A block's words, the first words and ends of all occurrences, and each row's items."""
    words, data = split(block, ALNUM_WORD, lower=True), LOWER[block.data]
    items: list[set] = [set() for _ in range(block.n)]
    starts, ends = [_EMPTY], [_EMPTY]
    for matcher in matchers:
        first, pattern = matcher.search(data, words)
        starts.append(first)
        ends.append(first + matcher.length)
        rows = np.searchsorted(words.bounds, first, side="right") - 1
        for row, p in {*zip(rows.tolist(), pattern.tolist())}:   # each pattern of a row once
            items[row].update(matcher.items(p))
    return words, np.concatenate(starts), np.concatenate(ends), items


def _hit_counts(words: Words, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    edge = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    total = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    np.cumsum(np.cumsum(edge[:-1]) > 0, out=total[1:])
    return np.diff(total[words.bounds])


SPANS, ITEMS, N_WORDS, N_HIT, ROW = "__wm_spans", "__wm_items", "__wm_words", "__wm_hit", "__wm_row"


def _search(docs: DataFrame, text_col: str, matchers) -> DataFrame:
    """Add (or extend) the span and item columns, and the counts over all spans so far."""
    later = SPANS in docs.columns
    kept = [f for f in docs.schema.fields if f.name not in (SPANS, ITEMS, N_WORDS, N_HIT)]
    schema = T.StructType(kept + [T.StructField(SPANS, T.ArrayType(T.LongType())), T.StructField(ITEMS, T.ArrayType(T.StringType())),
                                  T.StructField(N_WORDS, T.LongType()), T.StructField(N_HIT, T.LongType())])
    text_at, names = docs.columns.index(text_col), [f.name for f in kept]

    def run(batches):
        tables = matchers.value
        for batch in batches:
            for block in blocks(batch.column(text_at)):
                words, starts, ends, items = search_block(block, tables)
                rows = np.searchsorted(words.bounds, starts, side="right") - 1
                spans: list[list] = [[] for _ in range(block.n)]
                for row, a, b in zip(rows.tolist(), (starts - words.bounds[rows]).tolist(), (ends - words.bounds[rows]).tolist()):
                    spans[row] += (a, b)
                part = batch.slice(block.lo, block.n)
                if later:
                    for row, (old, had) in enumerate(zip(part.column(SPANS).to_pylist(), part.column(ITEMS).to_pylist())):
                        spans[row] += old
                        items[row].update(had)
                flat = np.array([x for s in spans for x in s], dtype=np.int64)
                base = np.repeat(words.bounds[:-1], [len(s) for s in spans])
                hit = _hit_counts(words, (flat + base)[0::2], (flat + base)[1::2])
                yield pa.record_batch([part.column(i) for i in range(len(names))]
                                      + [pa.array(spans, pa.list_(pa.int64())), pa.array([sorted(s) for s in items], pa.list_(pa.string())),
                                         pa.array(words.counts.astype(np.int64)), pa.array(hit)],
                                      names=[*names, SPANS, ITEMS, N_WORDS, N_HIT])

    return docs.mapInArrow(run, schema)


def _searched(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, window: int) -> DataFrame:
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))

    def matchers(c: int):
        mine = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(chunks)) == c) if chunks > 1 else items
        return spark.sparkContext.broadcast(build([(r[0], r[1]) for r in mine.toLocalIterator()], window))

    if chunks == 1:
        return _search(docs, text_col, matchers(0))
    numbered = stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "documents")
    found = []
    for c in range(chunks):
        tables = matchers(c)
        found.append(stage(_search(numbered.select(ROW, text_col), text_col, tables).where(F.size(SPANS) > 0).select(ROW, SPANS, ITEMS), "found"))
        tables.destroy()   # before the next chunk's
    rows = reduce(DataFrame.unionByName, found).groupBy(ROW).agg(   # at most one row per chunk
        F.flatten(F.collect_list(SPANS)).alias(SPANS), F.array_distinct(F.flatten(F.collect_list(ITEMS))).alias(ITEMS))
    both = numbered.join(rows, ROW, "left").drop(ROW)
    both = both.withColumns({SPANS: F.coalesce(SPANS, F.array().cast("array<bigint>")), ITEMS: F.coalesce(ITEMS, F.array().cast("array<string>"))})
    return _search(both, text_col, spark.sparkContext.broadcast([]))   # counts over all spans


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 13, ratio: int = 20) -> DataFrame:
    """Per document: id, ``n_words``, ``n_hit``, ``items`` (sorted ids as strings), ``spans``
    (word ranges begin, end, begin, end, ...) and ``contaminated``."""
    found = _searched(docs.select(id_col, text_col), benchmark, text_col, item_col, item_text_col, window)
    return found.select(id_col, F.col(N_WORDS).alias("n_words"), F.col(N_HIT).alias("n_hit"), F.col(ITEMS).alias("items"),
                        F.col(SPANS).alias("spans"),
                        ((F.col(N_HIT) > 0) & (F.lit(ratio) * F.col(N_HIT) >= F.col(N_WORDS))).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 13, ratio: int = 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = _searched(docs, benchmark, text_col, item_col, item_text_col, window)
    return (found.where(~((F.col(N_HIT) > 0) & (F.lit(ratio) * F.col(N_HIT) >= F.col(N_WORDS))))
            .select(*docs.columns))
