"""Token-id files with a minimal perfect hash index (operator 8).

*Encoding.* A byte-level BPE works on pre-tokens, so a text may be cut wherever its
pre-tokenizer surely cuts (before a space or line feed that follows a visible character,
and before ``,.;:!?`` that follows an ASCII letter). A tokenizer file of another kind (another
pre-tokenizer, a prefix space, a normalizer, added tokens across such cuts) is told by its
settings and gets whole texts. Equal pieces are encoded once per
worker by the ``tokenizers`` library and their ids are gathered for every occurrence.

*Files.* Documents are range-partitioned and sorted by key; each partition writes one
shard file, in a stream: the raw ids of its documents (2 or 4 bytes each, by vocabulary
size; every document ends with ``END``), then the document lengths, then a footer. A shard is written
under a name of its own attempt and moved into place, so a repeated task does no harm.

*Index.* Keys are hashed to buckets of about ``BUCKET_KEYS``; each bucket builds a
minimal perfect hash (a cascade of bit arrays: a key settles at the first level where it
is alone on its bit, its slot is the number of bits before it) and is one file: a head of fixed
size, 64-bit words with the number of bits before each, and slots of fixed width with the key's
fingerprint, shard, position and number of copies. :class:`TokenFiles` reads one key without
Spark: a word for each level tried (1.6 on average), one slot, the footer, lengths and ids of one
shard, all at computed offsets, whatever the size of the corpus. :func:`find` looks up many keys.

Null keys are a key of their own and sort first; rows that repeat a key lie next to each
other (ordered by text) and are all found through it; a null or empty text is the end id alone; very
long texts are whole; an empty table has no shards. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage, work_path
from .words import U64, blocks, byte_class, mix, span_hashes

END = 0
SHARD_BYTES = 32 << 20     # text bytes that make one shard
BUCKET_KEYS = 1 << 16      # keys of an index file
CACHE_PIECES = 2_000_000   # encoded pieces a worker keeps
LEVELS = 48
FOOTER = "<QQHHI"   # documents, ids, id width, version, magic
MAGIC, VERSION = 0x54494453, 1

_SPACE = byte_class((0x20, 0x20), (0x0A, 0x0A))
_VISIBLE = byte_class((0x21, 0x7E))
_STOP = byte_class(*[(ord(c), ord(c)) for c in ",.;:!?"])
_ASCII_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A))
_TWO_BYTE_LEAD = byte_class((0xC3, 0xDF))   # leads of two-byte characters, none of them white space


def _cuts_are_safe(settings: dict) -> bool:
    """Whether the pre-tokenizer is the byte-level one that splits at every cut made below, after
    nothing that rewrites the text, and no added token spans a cut or takes white space along."""
    before = settings["pre_tokenizer"] or {}
    return (before.get("type") == "ByteLevel" and not before["add_prefix_space"] and before.get("use_regex", True) and not settings["normalizer"]
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or set(" \n,.;:!?") & set(t["content"]) for t in settings["added_tokens"]))


class Encoder:
    """Ids of many texts, through a cache of encoded pieces."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cuts = _cuts_are_safe(json.loads(self.tokenizer.to_str()))
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._clear()

    def _clear(self):
        self.known = np.zeros(0, U64)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, self.dtype)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        if len(self.known) > CACHE_PIECES:
            self._clear()
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.array([len(i) for i in ids], dtype=np.int64)
        at = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate([self.pool, np.array([x for i in ids for x in i], dtype=self.dtype)])
        known = np.concatenate([self.known, keys])
        order = np.argsort(known)
        self.known = known[order]
        self.at, self.size = np.concatenate([self.at, at])[order], np.concatenate([self.size, size])[order]

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.known, keys), max(len(self.known) - 1, 0))
        return at, (self.known[at] == keys) if len(self.known) else np.zeros(len(keys), bool)

    def encode(self, block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block in order, and each row's bounds among them (without end ids)."""
        data, n = block.data, len(block.data)
        if not n:
            return np.zeros(0, self.dtype), np.zeros(block.n + 1, np.int64)
        cut = np.zeros(n, dtype=bool)
        if self.cuts:
            cut[1:] = (_SPACE[data[1:]] & _VISIBLE[data[:-1]]) | (_STOP[data[1:]] & _ASCII_LETTER[data[:-1]])
            cut[2:] |= _SPACE[data[2:]] & (data[1:-1] >= 0x80) & _TWO_BYTE_LEAD[data[:-2]]
        cut[block.offsets[:-1][block.offsets[:-1] < n]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        keys, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        new = np.flatnonzero(~self._find(keys)[1])
        if len(new):
            texts = [data[a:b].tobytes().decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            before = len(self.known)
            self._learn(keys[new], texts)
            if before > CACHE_PIECES:   # the cache was emptied: the block's other pieces again
                rest = np.flatnonzero(~self._find(keys)[1])
                self._learn(keys[rest], [data[a:b].tobytes().decode() for a, b in zip(starts[first[rest]], ends[first[rest]])])
        slot = self._find(keys)[0][inverse]
        size = self.size[slot]
        stop = np.cumsum(size)
        ids = self.pool[np.arange(stop[-1]) + np.repeat(self.at[slot] - stop + size, size)]
        total = np.append(0, stop)
        return ids, total[np.searchsorted(starts, block.offsets)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of ids of each text (without an end id)."""
    docs = docs.drop(out_col)
    at, names = docs.columns.index(text_col), docs.columns

    def run(batches):
        for batch in batches:
            counts = [np.diff(encoder(path).encode(block)[1]) for block in blocks(batch.column(at))]
            yield pa.record_batch([*batch.columns, pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))], names=[*names, out_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out_col, T.LongType())]))


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _shard_uri(root: str, shard: int) -> str:
    return f"{root}/shard-{shard:06d}.ids"


def write_shards(docs: DataFrame, path: str, root: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shard files; one row per document: key, shard, ordinal (in the shard),
    position (ids before it in the shard), n_tokens. Staged, so the files are written once."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    rows = (docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
            .repartitionByRange(count, "key").sortWithinPartitions("key", "text"))
    schema = T.StructType([T.StructField("key", docs.schema[id_col].dataType), T.StructField("shard", T.IntegerType()),
                           T.StructField("ordinal", T.LongType()), T.StructField("position", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def run(batches):
        shard, own = TaskContext.get().partitionId(), encoder(path)
        files, name = _filesystem(_shard_uri(root, shard))
        out, lengths, at, ordinal = None, [], 0, 0
        temporary = f"{name}.{uuid.uuid4().hex}"
        for batch in batches:
            for block in blocks(batch.column(1), 2 << 20):
                if out is None:
                    files.create_dir(os.path.dirname(name), recursive=True)
                    out = files.open_output_stream(temporary)
                ids, bounds = own.encode(block)
                out.write(np.insert(ids, bounds[1:], END).tobytes())
                n = np.diff(bounds) + 1
                lengths.append(n)
                yield pa.record_batch([batch.column(0).slice(block.lo, block.n), pa.array(np.full(block.n, shard, np.int32)),
                                       pa.array(ordinal + np.arange(block.n)), pa.array(at + np.cumsum(n) - n), pa.array(n)],
                                      names=["key", "shard", "ordinal", "position", "n_tokens"])
                at, ordinal = at + int(n.sum()), ordinal + block.n
        if out is not None:
            out.write(np.concatenate(lengths).astype("<u8").tobytes())
            out.write(struct.pack(FOOTER, ordinal, at, own.dtype.itemsize, VERSION, MAGIC))
            out.close()
            files.move(temporary, name)

    return stage(rows.mapInArrow(run, schema), "token_entries")


class Shard:
    """Random access to one shard file."""

    def __init__(self, root: str, shard: int):
        files, name = _filesystem(_shard_uri(root, shard))
        self.file = files.open_input_file(name)
        size, tail = self.file.size(), struct.calcsize(FOOTER)
        self.n, self.total, width, version, magic = struct.unpack(FOOTER, self.file.read_at(tail, size - tail))
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"{name} is not a token-id shard")
        self.dtype = np.dtype(f"<u{width}")

    def some_lengths(self, ordinal: int, count: int) -> np.ndarray:
        at = self.total * self.dtype.itemsize + 8 * ordinal
        return np.frombuffer(self.file.read_at(8 * count, at), dtype="<u8").astype(np.int64)

    def read(self, position: int, count: int) -> np.ndarray:
        width = self.dtype.itemsize
        return np.frombuffer(self.file.read_at(count * width, position * width), dtype=self.dtype)


def _key_text(column):
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def _hashed(rows: DataFrame) -> DataFrame:
    """Add the two hashes of the key (place and fingerprint)."""
    return (rows.withColumn("h", F.xxhash64(_key_text(F.col("key")), F.lit(1)))
            .withColumn("f", F.xxhash64(_key_text(F.col("key")), F.lit(2)).bitwiseAND(F.lit(0xFFFFFFFF))))


def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = (level + 1) * 0xD1342543DE82EF95 % (1 << 64)
    return ((mix(h + U64(salt)) >> U64(32)) * U64(size) >> U64(32)).astype(np.int64)


def build_hash(h: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays of a minimal perfect hash over distinct hashes, and the keys left after the
    last level (equal hashes; they take the last slots in order)."""
    levels, rest = [], np.arange(len(h))
    while len(rest) and len(levels) < LEVELS:
        place = _place(h[rest], len(levels), len(rest))
        bits = np.bincount(place, minlength=len(rest)) == 1
        levels.append(bits)
        rest = rest[~bits[place]]
    return levels, rest


def look_up(h: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Slot of every hash, -1 where it settles at no level."""
    slot, before, rest = np.full(len(h), -1, dtype=np.int64), 0, np.arange(len(h))
    for level, bits in enumerate(levels):
        place = _place(h[rest], level, len(bits))
        here = bits[place]
        slot[rest[here]] = before + (np.cumsum(bits) - 1)[place[here]]
        before += int(bits.sum())
        rest = rest[~here]
    return slot


WORD = np.dtype([("bits", "<u8"), ("rank", "<u4")])   # 64 places of a level, and the slots given before them
SLOT = np.dtype([("f", "<u4"), ("shard", "<i4"), ("ordinal", "<i8"), ("position", "<i8"), ("copies", "<i8")])
INDEX_HEAD = "<IHHQQQ"   # magic, version, levels, words, keys left, slots; then first word and size of each of LEVELS levels
HEAD_BYTES = struct.calcsize(INDEX_HEAD) + 16 * LEVELS


def _bucket_uri(root: str, bucket: int) -> str:
    return f"{root}/index-{bucket:06d}.mph"


def _write(uri: str, data: bytes) -> None:
    """A whole file, under a name of its own first: a repeated task replaces it by an equal one."""
    files, name = _filesystem(uri)
    files.create_dir(os.path.dirname(name), recursive=True)
    temporary = f"{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(temporary) as out:
        out.write(data)
    files.move(temporary, name)


def pack_bucket(h: np.ndarray, slots: np.ndarray) -> bytes:
    """The bytes of one bucket's file: levels with stored ranks, keys left over, slots (``SLOT``, in the order of ``h``)."""
    levels, rest = build_hash(h)
    slot = look_up(h, levels)
    slot[rest] = len(h) - len(rest) + np.arange(len(rest))
    packed = [np.packbits(np.pad(bits, (0, -len(bits) % 64)), bitorder="little").view("<u8") for bits in levels]
    words = np.zeros(sum(map(len, packed)), WORD)
    words["bits"] = np.concatenate([np.zeros(0, "<u8"), *packed])
    ones = np.bitwise_count(words["bits"]).astype(np.int64)
    words["rank"] = np.cumsum(ones) - ones
    table = np.zeros((LEVELS, 2), "<u8")
    size = np.array([len(p) for p in packed], np.int64)
    table[:len(levels)] = np.stack([np.cumsum(size) - size, [len(bits) for bits in levels]], axis=1) if levels else 0
    head = struct.pack(INDEX_HEAD, MAGIC, VERSION, len(levels), len(words), len(rest), len(slots))
    return b"".join([head, table.tobytes(), words.tobytes(), h[rest].astype("<u8").tobytes(), slots[np.argsort(slot)].tobytes()])


class Bucket:
    """One bucket of the index. Reads a fixed head, then single records by their offsets (one
    word a level tried, one slot), or out of the ``whole`` file where many keys are looked up."""

    def __init__(self, root: str, bucket: int, whole: bool = False):
        files, name = _filesystem(_bucket_uri(root, bucket))
        self.file = files.open_input_file(name)
        self.whole = self.file.read() if whole else None
        head = self._bytes(0, HEAD_BYTES)
        magic, version, levels, words, self.left, self.slots = struct.unpack_from(INDEX_HEAD, head)
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"{name} is not a bucket of a token index")
        self.levels = np.frombuffer(head, "<u8", offset=struct.calcsize(INDEX_HEAD)).astype(np.int64).reshape(-1, 2)[:levels].tolist()
        self.left_at = HEAD_BYTES + words * WORD.itemsize
        self.slots_at = self.left_at + 8 * self.left

    def _bytes(self, start: int, size: int) -> bytes:
        return self.file.read_at(size, start) if self.whole is None else self.whole[start:start + size]

    def _records(self, kind: np.dtype, base: int, at: np.ndarray) -> np.ndarray:
        if self.whole is not None:
            return np.frombuffer(self.whole, kind, count=int(at.max(initial=-1)) + 1, offset=base)[at]
        return np.array([np.frombuffer(self._bytes(base + i * kind.itemsize, kind.itemsize), kind)[0] for i in at.tolist()], dtype=kind)

    def find(self, h: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashed keys are there, and their slots' records."""
        slot, rest = np.full(len(h), -1, dtype=np.int64), np.arange(len(h))
        for level, (first, size) in enumerate(self.levels):
            if not len(rest):
                break
            place = _place(h[rest], level, size)
            word = self._records(WORD, HEAD_BYTES, first + (place >> 6))
            bit = U64(1) << (place & 63).astype(U64)
            here = (word["bits"] & bit) != 0
            slot[rest[here]] = (word["rank"] + np.bitwise_count(word["bits"] & (bit - U64(1))))[here]
            rest = rest[~here]
        if len(rest) and self.left:   # equal hashes: told apart by the fingerprint
            left = np.frombuffer(self._bytes(self.left_at, 8 * self.left), "<u8")
            stored = self._records(SLOT, self.slots_at, self.slots - self.left + np.arange(self.left))["f"]
            for i in rest.tolist():
                for j in np.flatnonzero((left == h[i]) & (stored == f[i])):
                    slot[i] = self.slots - self.left + j
        settled = np.flatnonzero(slot >= 0)
        records = self._records(SLOT, self.slots_at, slot[settled])
        same = records["f"] == f[settled]
        there = np.zeros(len(h), dtype=bool)
        there[settled[same]] = True
        return there, records[same]


def build_index(entries: DataFrame, root: str | None = None) -> tuple[str, int]:
    """Write the index of :func:`write_shards`' entries, a file for each bucket; returns its folder and number of buckets."""
    spark = entries.sparkSession
    root = root or work_path(spark, "token-index")
    count = max(1, -(-entries.count() // BUCKET_KEYS))
    keys = entries.groupBy("key").agg(F.min(F.struct("shard", "ordinal", "position")).alias("at"), F.count(F.lit(1)).alias("copies"))
    keys = _hashed(keys.select("key", "at.*", "copies")).drop("key").withColumn("bucket", F.pmod("h", F.lit(count)))

    def write(key, table, number):   # a bucket without keys has its file too, so a missing one is an error
        slots = np.zeros(table.num_rows, SLOT)
        for c in SLOT.names if table.num_rows else ():
            slots[c] = table.column(c).to_numpy()
        h = table.column("h").to_numpy().view(U64) if table.num_rows else np.zeros(0, U64)
        _write(_bucket_uri(root, key[0].as_py()), pack_bucket(h, slots))
        return pa.table({"keys": pa.array([len(h)], pa.int64())})

    numbers = spark.range(count).withColumnRenamed("id", "bucket")
    keys.groupBy("bucket").cogroup(numbers.groupBy("bucket")).applyInArrow(write, "keys bigint").agg(F.sum("keys")).first()
    _write(f"{root}/index.json", json.dumps({"version": VERSION, "buckets": count}).encode())
    return root, count


def find(keys: DataFrame, index: str, buckets: int, id_col: str) -> DataFrame:
    """Index entries of the distinct keys given (keys without one are left out). Only the keys are
    shuffled; a task reads the files of the buckets that its keys fall into, one at a time."""
    wanted = _hashed(keys.select(F.col(id_col).alias("key")).distinct()).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    schema = T.StructType([T.StructField("key", keys.schema[id_col].dataType), T.StructField("shard", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in ("ordinal", "position", "copies")]])

    def search(batches):
        number, bucket = None, None
        for batch in batches:
            key, h, f, owner = (batch.column(i) for i in range(4))
            h, f, owner = h.to_numpy().view(U64), f.to_numpy(), owner.to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1, [len(owner)]]) if len(owner) else [0]
            for lo, hi in zip(edges[:-1], edges[1:]):
                if owner[lo] != number:
                    number, bucket = owner[lo], Bucket(index, int(owner[lo]), whole=True)
                there, records = bucket.find(h[lo:hi], f[lo:hi])
                yield pa.record_batch([key.slice(lo, hi - lo).filter(pa.array(there)), *[pa.array(np.ascontiguousarray(records[c])) for c in SLOT.names[1:]]],
                                      names=["key", *SLOT.names[1:]])

    return wanted.select("key", "h", "f", "bucket").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(search, schema)


class TokenFiles:
    """Keyed access to finished files, without a Spark job: a read opens one bucket and one
    shard and reads records at computed offsets, however many documents there are.

    Keys are whole numbers, strings or None, as in the key column that was written."""

    def __init__(self, root: str):
        self.root = root
        files, name = _filesystem(f"{root}/index.json")
        with files.open_input_file(name) as file:
            self.buckets = json.loads(file.read())["buckets"]

    def locate(self, key: int | str | None) -> tuple[int, int, int, int] | None:
        """Shard, ordinal, position and number of copies of a key; None if its fingerprint is not there."""
        if isinstance(key, bool) or not isinstance(key, int | str | None):
            raise TypeError(f"keys are whole numbers, strings or None, not {type(key).__name__}")
        text = xxhash.xxh64_intdigest(b"null" if key is None else b"=" + str(key).encode(), seed=42)   # as in _hashed
        h, f = (xxhash.xxh64_intdigest(struct.pack("<i", n), seed=text) for n in (1, 2))
        signed = h - (1 << 64) if h >> 63 else h
        there, records = Bucket(self.root, signed % self.buckets).find(np.array([h], U64), np.array([f & 0xFFFFFFFF]))
        return tuple(int(records[0][c]) for c in SLOT.names[1:]) if there[0] else None

    def read(self, key: int | str | None) -> list[np.ndarray]:
        """The ids of each document of a key (with end ids); an empty list for an absent key."""
        entry = self.locate(key)
        if entry is None:
            return []
        shard = Shard(self.root, entry[0])
        lengths = shard.some_lengths(entry[1], entry[3])
        return np.split(shard.read(entry[2], int(lengths.sum())), np.cumsum(lengths)[:-1])


def read_documents(found: DataFrame, root: str, starts: DataFrame, id_col: str) -> DataFrame:
    """Read every found document's ids back: id, start (ids before it in all files), n_tokens,
    ids_crc32 (over little-endian 32-bit ids), shard."""
    kind = found.schema["key"].dataType
    schema = T.StructType([T.StructField(id_col, kind), *[T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")],
                           T.StructField("shard", T.IntegerType())])

    def read(key, table):
        number = key[0].as_py()
        shard = Shard(root, number)
        lengths, before = shard.some_lengths(0, shard.n), table.column("before")[0].as_py()
        order = np.argsort(table.column("ordinal").to_numpy(), kind="stable")
        pick, start, size, crc = [], [], [], []
        ordinal, position, copies = (table.column(c).to_numpy() for c in ("ordinal", "position", "copies"))
        for i in order.tolist():
            at = int(position[i])
            for n in lengths[ordinal[i]:ordinal[i] + copies[i]].tolist():
                ids = shard.read(at, n)
                pick.append(i)
                start.append(before + at)
                size.append(n)
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                at += n
        return pa.table({id_col: table.column("key").take(pa.array(pick, pa.int64())), "start": pa.array(start, pa.int64()),
                         "n_tokens": pa.array(size, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                         "shard": pa.array(np.full(len(pick), number, np.int32))})

    return found.join(starts, "shard").groupBy("shard").applyInArrow(read, schema)


def token_files(docs: DataFrame, path: str, root: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write shards and index of all documents, look every key up and read its ids back.

    Without a ``root`` the files live in the application's folder, until the driver program ends."""
    root = root or work_path(docs.sparkSession, "token-files")
    entries = write_shards(docs, path, root, id_col, text_col)
    index, buckets = build_index(entries, root)
    totals = entries.groupBy("shard").agg(F.sum("n_tokens").alias("n"))   # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return read_documents(find(docs, index, buckets, id_col), root, starts, id_col)
