"""Alignment of two tokenizers over the same text by galloping intersection (operator 13).

Tokenizer A is a byte-level BPE of the ``tokenizers`` library, B a ``sentencepiece`` model that
puts a space before the text; A encodes the text with the same space. Both token sequences
then spell the same bytes, and every token has a byte range. Offsets where a token of A and
one of B both end cut the sequences into groups.

*Galloping intersection.* Per document, the shorter list of ends drives the search into the
longer one: from the last position the step doubles until an end is not smaller, then a binary
search closes in. Long lists are cut into lanes of ``LANE`` ends, and all lanes of a block of
texts advance together in numpy. The indexes of common ends slice the groups; differences of
ranks (how many ends of B lie before an A token's start and end) give the range of B tokens that
it overlaps (:func:`overlaps`).

*Links.* Every A and every B token of one group are a link. A pair of ids counts the documents
that hold it linked. Tasks sum the counts of their documents before the shuffle. The pairs are
looked up again for every document: the most frequent ones (at most ``HOT_PAIRS``, a broadcast
of 20 MB) in each task, the others, each in few documents then, by a join; which way a pair goes
moves work, never results.

Null and empty texts, and texts that a tokenizer does not spell back (the joined token bytes differ
from space + text), have no tokens: all counts are zero, the groups' digest is empty. Texts
are whole whatever their length; special tokens' strings are plain text. Repeated rows are
documents of their own; ids may be null or repeated. An empty table gives no rows, extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .token_files import Encoder
from .words import Block, blocks, span_hashes

LANE = 64                  # ends of the shorter list that one lane walks
LINKS_AT_ONCE = 4 << 20    # links expanded at once
PAIRS_AT_ONCE = 4 << 20    # id pairs a task holds while it counts
HOT_PAIRS = 1 << 20        # id pairs looked up in every task
SPACE = 0x20


def byte_alphabet() -> dict[str, int]:
    """The characters that a byte-level vocabulary writes for the 256 bytes: printable Latin-1
    characters stand for themselves, the others for characters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """The bytes of every id, one after another, and where each begins."""
    data: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.append(0, np.cumsum([len(t) for t in tokens], dtype=np.int64)))

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The joined bytes of a sequence of ids."""
        return self.data[ragged(self.offsets[ids], self.sizes[ids])]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (size of them) for every pair, one after another."""
    stop = np.cumsum(sizes)
    return np.arange(stop[-1] if len(stop) else 0) + np.repeat(starts - (stop - sizes), sizes)


class ByteEncoder(Encoder):
    """Tokenizer A: the strings of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        alphabet, vocabulary = byte_alphabet(), self.tokenizer.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.vocabulary = Vocabulary.of(tokens)


class PieceEncoder(Encoder):
    """Tokenizer B. No piece holds a space after another character, so a text may be cut before
    every space that follows one; equal parts are encoded once (see :class:`Encoder`)."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path}: a piece goes on after a space")
        self.space = self.model.piece_to_id("▁")
        self.dtype = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")
        self.tokenizer = self   # the learning step of the base class calls encode_batch_fast
        self.vocabulary = Vocabulary.of([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                                         for i, p in enumerate(pieces)])
        self._clear()

    def encode_batch_fast(self, texts: list[str], add_special_tokens: bool = False) -> list:
        """Parts begin with a space; the model adds one to what it is given."""
        found = self.model.encode([t[1:] for t in texts], num_threads=1)
        return [_Ids(i if len(t) > 1 else [self.space]) for i, t in zip(found, texts)]

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        data, n = block.data, len(block.data)
        if not n:
            return np.zeros(0, self.dtype), np.zeros(block.n + 1, np.int64)
        cut = np.zeros(n, dtype=bool)
        cut[1:] = (data[1:] == SPACE) & (data[:-1] != SPACE)
        cut[block.offsets[:-1]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        keys, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)

        def learn() -> int:
            new, before = np.flatnonzero(~self._find(keys)[1]), len(self.known)
            if len(new):
                self._learn(keys[new], [data[a:b].tobytes().decode() for a, b in zip(starts[first[new]], ends[first[new]])])
            return before

        if learn() > len(self.known):   # the cache was emptied: the block's other parts again
            learn()
        slot = self._find(keys)[0][inverse]
        size = self.size[slot]
        return self.pool[ragged(self.at[slot], size)], np.append(0, np.cumsum(size))[np.searchsorted(starts, block.offsets)]


@dataclass
class _Ids:
    ids: list[int]


_encoders: dict[tuple, Encoder] = {}


def _encoder(kind, path: str):
    if (kind, path) not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _encoders[kind, path] = kind(path)
    return _encoders[kind, path]


def gallop(long: np.ndarray, at: np.ndarray, stop: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For every lane, the first index in [at, stop) whose value is not below the target (or stop):
    an exponential search from ``at``, then a binary search."""
    lo, hi = at.copy(), at.copy()
    step = 1
    ahead = np.flatnonzero(hi < stop)
    ahead = ahead[long[hi[ahead]] < target[ahead]]
    while len(ahead):
        lo[ahead] = hi[ahead] + 1
        hi[ahead] = np.minimum(hi[ahead] + step, stop[ahead])
        step *= 2
        ahead = ahead[hi[ahead] < stop[ahead]]
        ahead = ahead[long[hi[ahead]] < target[ahead]]
    open_ = np.flatnonzero(lo < hi)
    while len(open_):
        middle = (lo[open_] + hi[open_]) >> 1
        below = long[middle] < target[open_]
        lo[open_[below]] = middle[below] + 1
        hi[open_[~below]] = middle[~below]
        open_ = open_[lo[open_] < hi[open_]]
    return lo


def _driven(short: np.ndarray, s_bounds: np.ndarray, long: np.ndarray, l_bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (in the short and in the long list) of the common values of the given rows."""
    pieces = -(-(s_bounds[rows + 1] - s_bounds[rows]) // LANE)
    lane_row = np.repeat(rows, pieces)
    at = ragged(np.zeros(len(rows), np.int64), pieces) * LANE + s_bounds[lane_row]
    to = np.minimum(at + LANE, s_bounds[lane_row + 1])
    place, stop = l_bounds[lane_row].copy(), l_bounds[lane_row + 1]
    found_s, found_l = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    live = np.arange(len(at))
    while len(live):
        target = short[at[live]]
        here = gallop(long, place[live], stop[live], target)
        place[live] = here
        same = here < stop[live]
        same[same] = long[here[same]] == target[same]
        found_s.append(at[live[same]])
        found_l.append(here[same])
        at[live] += 1
        live = live[at[live] < to[live]]
    s, l = np.concatenate(found_s), np.concatenate(found_l)
    order = np.argsort(s)
    return s[order], l[order]


def common_ends(a: np.ndarray, a_bounds: np.ndarray, b: np.ndarray, b_bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes in ``a`` and ``b`` of the values that a row has in both (rising lists per row)."""
    a_short = np.diff(a_bounds) <= np.diff(b_bounds)
    one = _driven(a, a_bounds, b, b_bounds, np.flatnonzero(a_short))
    two = _driven(b, b_bounds, a, a_bounds, np.flatnonzero(~a_short))
    ia, ib = np.concatenate([one[0], two[1]]), np.concatenate([one[1], two[0]])
    order = np.argsort(ia)
    return ia[order], ib[order]


@dataclass
class Aligned:
    """A block's documents: the ids of both sides, each row's bounds, ends of groups (index of
    the last token of A and of B) and each row's bounds among the groups."""
    a: np.ndarray
    a_bounds: np.ndarray
    b: np.ndarray
    b_bounds: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray
    g_bounds: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray


def _keep(ids, bounds, rows):
    sizes = np.where(rows, np.diff(bounds), 0)
    return ids[np.repeat(rows, np.diff(bounds))], np.append(0, np.cumsum(sizes))


def _spelled(vocabulary: Vocabulary, ids: np.ndarray, bounds: np.ndarray, block: Block) -> np.ndarray:
    """Rows whose ids spell exactly their bytes."""
    total = np.append(0, np.cumsum(vocabulary.sizes[ids]))[bounds]
    same = np.diff(total) == np.diff(block.offsets)
    own, cuts = _keep(ids, bounds, same)
    wrong = vocabulary.spell(own) != block.data[np.repeat(same, np.diff(block.offsets))]
    kept = np.append(0, np.cumsum(np.where(same, np.diff(block.offsets), 0)))
    return same & (np.diff(np.append(0, np.cumsum(wrong))[kept]) == 0)


def align(block: Block, one: ByteEncoder, two: PieceEncoder) -> Aligned:
    """Both token sequences of every row and their groups."""
    spaced = Block(block.lo, block.hi, np.insert(block.data, block.offsets[:-1], SPACE), block.offsets + np.arange(block.n + 1))
    (a, a_bounds), (b, b_bounds) = one.encode(spaced), two.encode(spaced)
    rows = (np.diff(block.offsets) > 0) & _spelled(one.vocabulary, a, a_bounds, spaced) & _spelled(two.vocabulary, b, b_bounds, spaced)
    (a, a_bounds), (b, b_bounds) = _keep(a, a_bounds, rows), _keep(b, b_bounds, rows)
    a_ends, b_ends = np.cumsum(one.vocabulary.sizes[a]), np.cumsum(two.vocabulary.sizes[b])   # rows follow each other on both sides alike
    last_a, last_b = common_ends(a_ends, a_bounds, b_ends, b_bounds)
    return Aligned(a, a_bounds, b, b_bounds, last_a, last_b, np.searchsorted(last_a, a_bounds), a_ends, b_ends)


def overlaps(x: Aligned) -> tuple[np.ndarray, np.ndarray]:
    """For every A token, the first and the last B token whose bytes it overlaps (indexes inside
    the block): the ranks of its start and of its last byte among the ends of B."""
    starts = np.append(0, x.a_ends[:-1])[:len(x.a_ends)]
    return np.searchsorted(x.b_ends, starts, "right"), np.searchsorted(x.b_ends, x.a_ends, "left")


def _group_sizes(x: Aligned) -> tuple[np.ndarray, np.ndarray]:
    return np.diff(x.last_a, prepend=-1), np.diff(x.last_b, prepend=-1)


def _digits(vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of all ids (left-justified, one cell to spare) and their number."""
    text = np.arange(vocabulary).astype("S")
    width = text.dtype.itemsize
    cells = np.zeros((vocabulary, width + 1), np.uint8)
    cells[:, :width] = text.view(np.uint8).reshape(vocabulary, width)
    return cells, np.char.str_len(text).astype(np.int64)


_digit_tables: dict[int, tuple] = {}


def group_texts(x: Aligned, vocabulary: int):
    """For every row with tokens: (row, its groups as ``a1,a2|b1;a3|b2,b3``)."""
    if vocabulary not in _digit_tables:
        _digit_tables[vocabulary] = _digits(vocabulary)
    cells, widths = _digit_tables[vocabulary]
    p, q = _group_sizes(x)
    at_a = np.arange(len(x.a)) + np.repeat(np.append(0, x.last_b[:-1] + 1)[:len(p)], p)
    at_b = np.arange(len(x.b)) + np.repeat(x.last_a + 1, q)
    ids, mark = np.zeros(len(x.a) + len(x.b), np.int64), np.full(len(x.a) + len(x.b), ord(","), np.uint8)
    ids[at_a], ids[at_b] = x.a, x.b
    mark[at_a[x.last_a]], mark[at_b[x.last_b]] = ord("|"), ord(";")
    size, rows = widths[ids], cells[ids]
    rows[np.arange(len(ids)), size] = mark
    flat = rows[np.arange(rows.shape[1]) <= size[:, None]]
    ends = np.append(0, np.cumsum(size + 1))[x.a_bounds + x.b_bounds]
    for row in np.flatnonzero(np.diff(x.a_bounds)).tolist():
        yield row, flat[ends[row]:ends[row + 1] - 1]


def linked_pairs(x: Aligned, b_size: int, pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct id pairs of every row (a * b_size + b, rising), how many links each has, and the rows' bounds."""
    p, q = _group_sizes(x)
    partners, first = np.repeat(q, p), np.repeat(np.append(0, x.last_b[:-1] + 1)[:len(p)], p)
    base = np.repeat(np.arange(len(x.a_bounds) - 1), np.diff(x.a_bounds)) * pairs + x.a.astype(np.int64) * b_size
    total = np.append(0, np.cumsum(partners))
    keys, times, lo = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while lo < len(x.a):
        hi = max(int(np.searchsorted(total, total[lo] + LINKS_AT_ONCE, "right")) - 1, lo + 1)
        found = np.sort(np.repeat(base[lo:hi], partners[lo:hi]) + x.b[ragged(first[lo:hi], partners[lo:hi])])
        cut = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
        keys.append(found[cut])
        times.append(np.diff(np.append(cut, len(found))))
        lo = hi
    key, n = np.concatenate(keys), np.concatenate(times)
    if len(keys) > 2:   # parts of a row may lie in several chunks
        key, n = summed(key, n)
    return key % pairs, n, np.searchsorted(key, np.arange(len(x.a_bounds)) * pairs)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return keys[first], np.add.reduceat(values, first) if len(first) else values


def _packed(values: np.ndarray) -> bytes:
    """One, four or eight bytes a value: the least that all fit in."""
    top = int(values.max(initial=0))
    return values.astype("u1" if top < 1 << 8 else "<u4" if top < 1 << 32 else "<u8").tobytes()


def _unpacked(raw: bytes, count: int) -> np.ndarray:
    return np.frombuffer(raw, {0: "u1", 1: "u1", 4: "<u4", 8: "<u8"}[len(raw) // max(count, 1)]).astype(np.int64)


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, tokens of both sides, ends of its groups (1-based index of each
    group's last token in A and in B) and the B tokens that every A token overlaps (first and last, 1-based)."""
    names = ["tokens_a", "tokens_b", "group_ends_a", "group_ends_b", "overlap_first", "overlap_last"]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *[T.StructField(n, T.ArrayType(T.IntegerType())) for n in names]])

    def run(batches):
        one, two = _encoder(ByteEncoder, a_path), _encoder(PieceEncoder, b_path)
        for batch in batches:
            for block in blocks(batch.column(1)):
                x = align(block, one, two)
                first, last = overlaps(x)

                def lists(values, bounds, start):
                    values = values - np.repeat(start, np.diff(bounds))
                    return pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(values.astype(np.int32)))

                zero, ga, gb = np.zeros(block.n, np.int64), x.a_bounds[:-1] - 1, x.b_bounds[:-1] - 1
                yield pa.record_batch([batch.column(0).slice(block.lo, block.n), lists(x.a.astype(np.int64), x.a_bounds, zero), lists(x.b.astype(np.int64), x.b_bounds, zero),
                                       lists(x.last_a, x.g_bounds, ga), lists(x.last_b, x.g_bounds, gb),
                                       lists(first, x.a_bounds, gb), lists(last, x.a_bounds, gb)], names=[id_col, *names])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _documents(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """Per document: counts, the digest of its groups, and its distinct id pairs with their links, packed."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *[T.StructField(c, T.LongType()) for c in COUNTS],
                           T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", T.BinaryType()), T.StructField("n_pairs", T.LongType()),
                           T.StructField("times", T.BinaryType())])

    def run(batches):
        one, two = _encoder(ByteEncoder, a_path), _encoder(PieceEncoder, b_path)
        a_size, b_size = len(one.vocabulary.sizes), len(two.vocabulary.sizes)
        for batch in batches:
            for block in blocks(batch.column(1)):
                x = align(block, one, two)
                digest = [""] * block.n
                for row, text in group_texts(x, max(a_size, b_size)):
                    digest[row] = hashlib.sha256(text).hexdigest()
                key, times, bounds = linked_pairs(x, b_size, a_size * b_size)
                n_links = np.diff(np.append(0, np.cumsum(times))[bounds])
                cuts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                counts = [np.diff(x.a_bounds), np.diff(x.b_bounds), np.diff(x.g_bounds), n_links]
                yield pa.record_batch([batch.column(0).slice(block.lo, block.n), *[pa.array(c.astype(np.int64)) for c in counts], pa.array(digest, pa.string()),
                                       pa.array([_packed(key[i:j]) for i, j in cuts], pa.binary()), pa.array(np.diff(bounds)),
                                       pa.array([_packed(times[i:j]) for i, j in cuts], pa.binary())], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n): in how many documents each id pair is linked; tasks add up theirs before the shuffle."""
    def run(batches):
        held: list[np.ndarray] = []
        known, n, size = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

        def add():
            keys = np.concatenate([known, *held])
            return summed(keys, np.concatenate([n, np.ones(len(keys) - len(known), np.int64)]))

        for batch in batches:
            for raw, count in zip(batch.column(0), batch.column(1).to_pylist()):
                held.append(_unpacked(raw.as_py(), count))
                size += count
                if size > PAIRS_AT_ONCE:
                    known, n = add()
                    held.clear()
                    size = 0
                    if len(known) > PAIRS_AT_ONCE:
                        yield pa.record_batch([pa.array(known), pa.array(n)], names=["pair", "n"])
                        known, n = known[:0], n[:0]
        known, n = add()
        yield pa.record_batch([pa.array(known), pa.array(n)], names=["pair", "n"])

    return found.select("pairs", "n_pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _hot_threshold(counts: DataFrame, hot_pairs: int) -> int:
    """The least power of two such that at most ``hot_pairs`` pairs have as many documents."""
    sizes = dict(counts.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().collect())   # one row per power of two
    total, power = 0, 63
    while power >= 0 and total + sizes.get(power, 0) <= hot_pairs:
        total += sizes.get(power, 0)
        power -= 1
    return 1 << (power + 1)


def alignment_counts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best (links whose pair has the highest
    count of its A id), count_sum (counts of all links' pairs) and the digest of its groups."""
    import sentencepiece
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    found = stage(_documents(docs, a_path, b_path, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "aligned")
    top = F.max("n").over(Window.partitionBy(F.floor(F.col("pair") / F.lit(b_size))))   # an A id has at most one pair per B id
    counts = stage(_pair_counts(found).withColumn("best", F.col("n") == top), "pair-counts")
    threshold = _hot_threshold(counts, hot_pairs)
    hot = counts.where(F.col("n") >= threshold).toArrow()
    order = np.argsort(hot.column("pair").to_numpy())
    table = docs.sparkSession.sparkContext.broadcast(tuple(np.asarray(hot.column(c))[order] for c in ("pair", "n", "best")))
    names = ["id", *COUNTS, "groups_sha256", "row"]
    schema = T.StructType([found.schema[c] for c in names] + [T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")]
                          + [T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))])

    def run(batches):
        known, n, best = table.value
        for batch in batches:
            n_best, count_sum, left, left_times = [], [], [], []
            for raw, count, raw_times in zip(*(batch.column(c).to_pylist() for c in ("pairs", "n_pairs", "times"))):
                pairs, times = _unpacked(raw, count), _unpacked(raw_times, count)
                at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
                here = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
                at, own = at[here], times[here]
                n_best.append(int(own[best[at]].sum()) if len(at) else 0)
                count_sum.append(int((own * n[at]).sum()) if len(at) else 0)
                left.append(pairs[~here])
                left_times.append(times[~here])
            yield pa.record_batch([*[batch.column(c) for c in names], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()),
                                   pa.array(left, pa.list_(pa.int64())), pa.array(left_times, pa.list_(pa.int64()))], names=schema.names)

    looked = found.mapInArrow(run, schema)
    if threshold > 1:   # the rarer pairs, each in fewer documents than that
        looked = stage(looked, "looked-up")
        rest = looked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), "x.times")
        more = (rest.join(counts.where(F.col("n") < threshold), "pair").groupBy("row")
                .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")))
        looked = looked.join(more, "row", "left").withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
                                                               "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return looked.select(F.col("id").alias(id_col), *COUNTS, "n_best", "count_sum", "groups_sha256")
