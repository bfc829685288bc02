"""Operators 1, 5, 6 and 8: exact round trips and brute force on awkward rows."""

import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weblake.llm import queries, sharding, token_files, token_rollups, url_filter
from weblake.llm.words import PLAIN_WORD
from weblake.session import shared_dir

from . import helpers as H

DOCS = "doc_id bigint, text string"
CHANGE = "source string, lang string, tokenizer_version string, kind string, n_tokens bigint, old_tokens bigint"


def totals(rollup):
    return {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()}


def test_rollup_matches_a_ledger(spark, tmp_path):
    rng = random.Random(1)
    rollup, ledger = token_rollups.TokenRollup(spark, str(tmp_path)), {}
    for batch in range(4):
        rows = []
        for _ in range(60):
            key = (rng.choice(["hot", "hot", "a", None]), rng.choice(["en", None]), rng.choice(["v1", "v2"]))
            kind, n, old = rng.choice(["insert", "delete", "revise"]), rng.choice([None, 3, 10]), rng.choice([None, 2])
            rows.append((*key, kind, n, old))
            docs, tokens = ledger.get(key, (0, 0))
            ledger[key] = (docs + {"insert": 1, "delete": -1, "revise": 0}[kind],
                           tokens + {"insert": n or 0, "delete": -(n or 0), "revise": (n or 0) - (old or 0)}[kind])
        changed = spark.createDataFrame(rows, CHANGE).withColumn("docs", F.lit(7))
        assert rollup.commit(f"b/{batch}", changed) and not rollup.commit(f"b/{batch}", changed)
        assert totals(rollup) == ledger
        if batch == 1:
            rollup.compact()
            assert totals(rollup) == ledger and not rollup.commit("b/0", changed)
    assert rollup.commit("empty", spark.createDataFrame([], CHANGE)) and totals(rollup) == ledger
    assert totals(token_rollups.TokenRollup(spark, str(tmp_path))) == ledger


def test_rollup_refuses_unknown_kinds_and_hides_failed_batches(spark, tmp_path, monkeypatch):
    rollup = token_rollups.TokenRollup(spark, str(tmp_path))
    assert totals(rollup) == {}
    for kind in ("upsert", None):
        with pytest.raises(Exception, match="unknown kind of change"):
            rollup.commit("bad", spark.createDataFrame([("s", "en", "v", kind, 1, None)], CHANGE))
    good = spark.createDataFrame([("s", "en", "v", "insert", 1, None)], CHANGE)
    with monkeypatch.context() as m:
        m.setattr(rollup.log, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            rollup.commit("good", good)
    assert totals(rollup) == {}
    assert rollup.commit("good", good) and totals(rollup) == {("s", "en", "v"): (1, 1)}


def test_overlapping_compactions_count_every_batch_once(spark, tmp_path, monkeypatch):
    def rollup():
        return token_rollups.TokenRollup(spark, str(tmp_path))

    def insert(n):
        return spark.createDataFrame([("s", "en", "v", "insert", n, None)], CHANGE)

    one, two = rollup(), rollup()
    one.commit("a", insert(4))
    one.commit("b", insert(6))
    real, done = one.log.publish, []

    def late(*args):   # the other compaction, and one more batch, come in between
        done.append(two.compact())
        two.commit("c", insert(5))
        return real(*args)

    with monkeypatch.context() as m:
        m.setattr(one.log, "publish", late)
        assert one.compact() is False and done == [True]
    assert totals(rollup()) == {("s", "en", "v"): (3, 15)}
    assert one.compact() and two.compact() and totals(rollup()) == {("s", "en", "v"): (3, 15)}
    assert not rollup().commit("a", insert(4))
    with pytest.raises(ValueError):
        one.commit("compaction 00000009", insert(1))


def test_word_counts(spark):
    rows = H.awkward_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumn("n", F.lit(1))
    got = token_rollups.count_words(docs, {"n": (PLAIN_WORD, None)})
    assert got.columns == ["doc_id", "n"]
    assert sorted((r.n for r in got.collect())) == sorted(len(H.words(t)) for _, t in rows)


URLS = [None, "", "no scheme", "http://", "http://A.com", "http://a.COM/", "https://x.example.com/en/1", "http://www.example.com/en/2?utm_source=x",
        "http://b.net/es/1", "http://net/fr/1", "http://xnet/fr/1", "ftp://b.net/es?x=/es/", "http://spam.org/p/?b=2&a=1&utm_x=3#top",
        "https://www.spam.org/p?a=1&b=2&ref=q", "http://spam.org/p?a=1", "http://c.net/es", "a://b://c.net/es/"]


def verdict(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = H.lower(rest[:cut]), rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(r, a) for r, a in queries.RULES for site, _, p in [r.partition("/")]
            if (host == site or host.endswith("." + site)) and path.startswith("/" + p)]
    rule = max(fits, key=lambda x: len(x[0]), default=None)
    return host, path, rule and rule[0], rule[1] if rule else ("block" if listed else "allow")


def test_url_verdicts_match_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit("clash"))
    listed = spark.createDataFrame([("http://spam.org/p?b=2&a=1",), ("http://SPAM.org/p/?a=1&b=2",), (None,), ("",), ("http://b.net/es/1",)], "url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.listed) for r in url_filter.judge(pages, listed, queries.RULES).collect()}
    assert len(got) == len(rows)
    for i, u in rows:
        on_list = u in (URLS[8], URLS[12], URLS[13])
        assert got[i][4] == on_list, u
        assert got[i][:4] == verdict(u, on_list), u
    nothing = url_filter.judge(pages, listed.limit(0), queries.RULES)
    assert nothing.where("listed").count() == 0 and nothing.count() == len(rows)
    assert url_filter.judge(pages.limit(0), listed, queries.RULES).count() == 0


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    listed = spark.range(0, 20000).select(F.concat(F.lit("k"), "id").alias("k"))
    blocks, count = url_filter.bloom_blocks(listed, "k", 20000)
    probe = spark.range(0, 120000).select("id", F.concat(F.lit("k"), "id").alias("k"))
    hits = url_filter.possible_hits(probe, "k", blocks, count).where("__possible")
    assert hits.where("id < 20000").count() == 20000
    assert hits.where("id >= 20000").count() < 1000


def test_feistel_is_a_bijection_of_any_size():
    for n in [1, 2, 3, 7, 64, 65, 1000, 4097]:
        assert sorted(sharding.permute(np.arange(n), n, 5).tolist()) == list(range(n))
    assert sharding.permute(np.arange(1000), 1000, 5).tolist() != sharding.permute(np.arange(1000), 1000, 6).tolist()


def test_shards_of_awkward_rows(spark):
    rows = H.awkward_rows() * 3
    docs = spark.createDataFrame(rows, DOCS).withColumns({"shard": F.lit("clash"), "size": F.lit(1)})
    got = sharding.shuffle_shards(docs, 16, 3).collect()
    assert sorted(r.row for r in got) == sorted(r.place for r in got) == list(range(len(rows)))
    want = sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows), key=str)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=str) == want
    in_order = [(r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32) for r in sorted(got, key=lambda r: r.row)]
    assert in_order == sorted(in_order)
    for s in range(16):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots))) and len(rows) // 16 <= len(slots) <= -(-len(rows) // 16)
    again = {(r.row, r.place) for r in sharding.shuffle_shards(docs.repartition(7), 16, 3).collect()}
    assert again == {(r.row, r.place) for r in got}
    assert sharding.shuffle_shards(docs.limit(0), 16, 3).count() == 0


def reference_files(rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(queries.bpe_path())
    out, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


ODD = ["a  b\n\n c\t d ", " \u00a0x\u00a0 \u00a0 y", "don't! isn't?they'll, I'd.x", "<|endoftext|> a <|endoftext|>b,c", "é è, ñ.ü\u3000z \u2028q", "\x1c \x1d!\x1c foo",
       "\r\n\r\n line\r\n", "x\u0085 y", "日本 語 テキスト, ok", "١٢٣ 123,456.78 ½ ²", "🙂 🙂🙂 a🙂 .🙂", "× ×, ÷. x×,y", "tail   ", "\n", "'s 's't 're", "...!!! ,,, ;;a;b"]


def test_token_files_match_whole_texts(spark, monkeypatch):
    rng = random.Random(3)
    alphabet = list("ab Z.,'!\n\t\r19é×ñ\u00a0\u3000語🙂<|>")
    rows = H.awkward_rows() + [(100 + i, t) for i, t in enumerate(ODD)]
    rows += [(200 + i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))) for i in range(150)]
    rows += [(500, H.prose(rng, 300_000)), (7, "again"), (7, None)]
    monkeypatch.setattr(token_files, "BUCKET_KEYS", 20)
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("key", "start", "shard", "n_tokens", "h", "f")})
    got = [tuple(r)[:4] for r in token_files.token_files(docs, queries.bpe_path()).collect()]
    assert sorted(got, key=lambda r: r[1]) == reference_files(rows)
    counted = token_files.count_tokens(docs, queries.bpe_path())
    assert sorted(r.n_tokens + 1 for r in counted.collect()) == sorted(r[2] for r in got)


def test_token_files_of_an_empty_table_and_absent_keys(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], DOCS)
    assert token_files.token_files(docs.limit(0), queries.bpe_path()).count() == 0
    root = f"{shared_dir(spark)}/files"
    entries = token_files.write_shards(docs, queries.bpe_path(), root)
    index, buckets = token_files.build_index(entries)
    keys = spark.createDataFrame([(i,) for i in [3, 7, 777, -1, None]], "doc_id bigint")
    assert sorted(r.key for r in token_files.find(keys, index, buckets, "doc_id").collect()) == [3, 7]
    assert token_files.find(keys.limit(0), index, buckets, "doc_id").count() == 0


def test_perfect_hash_is_minimal_and_settles_equal_hashes():
    h = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    h[10] = h[11]
    levels, rest = token_files.build_hash(h)
    assert sorted(rest.tolist()) == [10, 11]
    slot = token_files.look_up(h, levels)
    others = np.delete(np.arange(5000), [10, 11])
    assert sorted(slot[others].tolist()) == list(range(4998)) and (slot[[10, 11]] == -1).all()
    empty, none = token_files.build_hash(h[:0])
    assert empty == [] and len(none) == 0 and token_files.look_up(h[:3], empty).tolist() == [-1, -1, -1]


def test_stored_ranks_give_the_slots_of_the_bit_arrays(tmp_path):
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 63, 64, 65, 3000):
        h = rng.integers(0, 1 << 63, n).astype(np.uint64)
        if n > 64:
            h[10] = h[11]
        slots = np.zeros(n, token_files.SLOT)
        slots["f"], slots["position"] = rng.integers(0, 1 << 32, n), np.arange(n)
        token_files._write(token_files._bucket_uri(str(tmp_path), n), token_files.pack_bucket(h, slots))
        f = slots["f"].astype(np.int64)
        for whole in (True, False):
            bucket = token_files.Bucket(str(tmp_path), n, whole)
            there, found = bucket.find(h, f)
            assert there.all() and found["position"].tolist() == list(range(n))
            there, found = bucket.find(rng.integers(0, 1 << 63, 50).astype(np.uint64), np.full(50, 5))
            assert not there.any() and not len(found)


def test_one_key_is_read_by_offsets_without_spark(spark, monkeypatch):
    texts = ["text 0", None, "", "é ñ, x. y", "twice", "twice and more"]
    rows = [(i, f"document {i}, {'w ' * (i % 9)}") for i in range(3000)] + [(10_000 + i, t) for i, t in enumerate(texts)] + [(5, "copy"), (5, None), (None, "no key")]
    root = f"{shared_dir(spark)}/keyed"
    docs = spark.createDataFrame(rows, DOCS)
    entries = token_files.write_shards(docs, queries.bpe_path(), root)
    assert token_files.build_index(entries, root) == (root, 1)
    expected = {}
    for d, _, n, crc in reference_files(rows):
        expected.setdefault(d, []).append((n, crc))
    read, plain = [], token_files.Bucket._bytes
    monkeypatch.setattr(token_files.Bucket, "_bytes", lambda self, start, size: (read.append(size), plain(self, start, size))[1])
    files = token_files.TokenFiles(root)
    for key in [None, 5, *range(0, 3000, 37), *range(10_000, 10_006)]:
        read.clear()
        got = [(len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for ids in files.read(key)]
        assert got == expected[key]
        assert sum(read) <= token_files.HEAD_BYTES + token_files.LEVELS * token_files.WORD.itemsize + token_files.SLOT.itemsize
    assert files.read(777_777) == []
    with pytest.raises(TypeError):
        files.read(5.0)


def test_keyed_reads_of_string_keys_and_an_empty_table(spark):
    for rows in ([("a", "x y"), ("b", None), ("", "empty key"), ("null", "a word"), (None, "none")], []):
        root = f"{shared_dir(spark)}/strings-{len(rows)}"
        docs = spark.createDataFrame(rows, "doc_id string, text string")
        token_files.build_index(token_files.write_shards(docs, queries.bpe_path(), root), root)
        files = token_files.TokenFiles(root)
        for key, text in rows:
            (_, _, n, crc), = reference_files([(key, text)])
            assert [(len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for ids in files.read(key)] == [(n, crc)]
        assert len(files.read(None)) == (1 if rows else 0) and files.read("c") == []


def test_other_tokenizers_get_whole_texts(spark, tmp_path):
    from tokenizers import Tokenizer
    with open(queries.bpe_path(), encoding="utf-8") as file:
        plain = json.load(file)
    space = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}
    one = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    token = [{"id": 50257, "content": "b, c", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False}]
    texts = [t for _, t in H.awkward_rows() if t] + ODD + ["a b, c d b, c.", "  The end. of  it"]
    for i, change in enumerate([{}, {"pre_tokenizer": space}, {"pre_tokenizer": one}, {"normalizer": {"type": "Strip", "strip_left": True, "strip_right": True}},
                                {"added_tokens": plain["added_tokens"] + token}]):
        path = str(tmp_path / f"{i}.json")
        with open(path, "w", encoding="utf-8") as file:
            json.dump(plain | change, file)
        tokenizer = Tokenizer.from_file(path)
        assert token_files.Encoder(path).cuts == (not change)
        docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
        assert {r.doc_id: r.n_tokens for r in token_files.count_tokens(docs, path).collect()} == {
            j: len(tokenizer.encode(t, add_special_tokens=False).ids) for j, t in enumerate(texts)}


def test_url_list_of_the_query_is_no_host_pattern(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op5_blocked_bloom_urls"](spark, sf).collect()
    hosts = {}
    for r in rows:
        hosts.setdefault(r.host, set()).add(r.listed)
    assert sum(len(v) == 2 for v in hosts.values()) >= 3   # hosts with listed and other pages
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    own = {r.page_id for r in pages.where(F.md5(F.col("html").cast("binary")).rlike(f"^{queries.REJECTED}")).collect()}
    assert {r.page_id for r in rows if r.listed} >= {i for i in own if i in {r.page_id for r in rows if r.host}}


def test_hot_urls_are_split(spark):
    from ..test_skew import _skew_conf
    with _skew_conf(spark):
        i = F.col("id")
        pages = spark.range(300_000).select(F.col("id").alias("page_id"), F.xxhash64("id").alias("v"), F.when(i % 5 != 0, F.lit("http://hot.example.org/a")).otherwise(
            F.concat(F.lit("http://h"), (i % 997).cast("string"), F.lit(".example.org/"), i.cast("string"))).alias("url"))
        listed = spark.range(3000).select(F.concat(F.lit("http://h"), (i % 997).cast("string"), F.lit(".example.org/"), i.cast("string")).alias("url")).unionByName(
            spark.createDataFrame([("http://www.hot.example.org/a/?utm_source=x",)], "url string"))
        df = url_filter.judge(pages, listed, [])
        assert len(df.where("verdict = 'block'").collect()) == 240_000 + 600
        assert len(df.collect()) == 300_000
        assert df._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin(skew=true)") >= 2
