"""Vector codes, SimHash ball hashing and tokenizer alignment against brute force."""

import collections
import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from weblake.llm import alignment, ball_hashing, pivot_codes, queries
from weblake.llm.words import blocks

from . import helpers as H

# ---------------------------------------------------------------- operator 12


def brute_codes(rows, parts=4, entries=256, rounds=4):
    """(id, label, code, error) of kept rows of one dimension, and the final codebooks."""
    kept = [(i, lab, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = len(kept[0][2]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, _, v in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = collections.defaultdict(list)
            for c in cut:
                members[nearest(c[p], books[p])[1]].append(c[p])
            for e, own in members.items():
                books[p][e] = [sum(col) // len(own) for col in zip(*own)]
    out = []
    for (i, lab, _), c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    return out, books


VECTORS = "vec_id long, embedding array<float>, label int, code string, id string"


def vector_rows(seed=3, n=60, dims=8):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(dims)], rng.choice([0, 1, None])) for i in rng.sample(range(-40, 500), n)]
    rows += [(1000, None, 1), (1001, [None] + [0.1] * (dims - 1), 1), (1002, [float("nan")] + [0.1] * (dims - 1), 0),
             (1003, [float("inf")] * dims, 0), (rows[0][0], rows[0][1], rows[0][2]), (rows[1][0], rows[2][1], 0), (None, rows[3][1], None)]
    return rows


def test_codes_equal_brute_force(spark):
    for entries in (256, 16):   # fewer rows than entries, and more
        rows = vector_rows()
        df = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS).repartition(3)
        got = pivot_codes.vector_codes(df, entries=entries)
        want, books = brute_codes(rows, entries=entries)
        label_error = collections.Counter()
        for _, lab, _, e in want:
            label_error[lab] += e
        assert [b.tolist() for b in got.codebooks] == books
        found = pivot_codes.with_label_error(got.rows).select("id", "label", "code", "error", "label_error").collect()
        assert sorted(map(tuple, found), key=str) == sorted(((*w, label_error[w[1]]) for w in want), key=str)
        text = ",".join(str(x) for b in books for e in b for x in e)
        assert got.sha256() == hashlib.sha256(text.encode()).hexdigest()


def test_codes_of_other_lengths_and_empty_tables(spark):
    rows = [(1, [0.1] * 8, 0), (2, [0.2] * 4, 0), (3, [], 1), (0, [0.3] * 6, 1)]   # the first that can be cut has 8
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS)
    got = {r.id: (r.code, r.error) for r in pivot_codes.with_label_error(pivot_codes.vector_codes(df).rows).collect()}
    assert got == {1: ("00000000", 0), 2: (None, None), 3: (None, None), 0: (None, None)}
    for none in (df.limit(0), df.where("vec_id = 3")):
        found = pivot_codes.vector_codes(none)
        assert pivot_codes.with_label_error(found.rows).count() == none.count()
        assert found.sha256() == hashlib.sha256(b"").hexdigest()
    with pytest.raises(Exception, match="exceeds"):
        pivot_codes.vector_codes(spark.createDataFrame([(1, [1e30] * 4, 0, "x", "y")], VECTORS))


def test_pivots_prune_and_ties_go_to_the_lower_index():
    rng = np.random.default_rng(5)
    centres = rng.integers(-2000, 2000, (20, 4))
    x = centres[rng.integers(0, 20, 3000)] + rng.integers(-40, 40, (3000, 4))
    book = np.concatenate([x[:120], x[:60]])   # repeated entries: ties
    pivots = pivot_codes.choose_pivots(book)
    far = pivot_codes.pivot_distances(x, pivots).astype(np.float32)
    index, best, evaluated = pivot_codes.nearest(x, far, book, pivot_codes.pivot_distances(book, pivots))
    whole = pivot_codes.distances(x[:, None, :], book[None, :, :])
    assert (index == whole.argmin(axis=1)).all() and (best == whole.min(axis=1)).all()
    assert evaluated < 0.25 * whole.size   # the rest was ruled out by the bounds


@pytest.mark.parametrize("top, entries, rows", [(3, 200, 500), (900, 256, 3000), (50_000, 100, 700), (1 << 29, 90, 300), (900, 1, 5), (900, 3, 0)])
def test_nearest_entries_equal_brute_force_at_every_width(top, entries, rows):
    """Products in 32 and 64 bit floats and, beyond them, integers; many ties where components are small."""
    rng = np.random.default_rng(top)
    book, x = rng.integers(-top, top + 1, (entries, 8)), rng.integers(-top, top + 1, (rows, 8))
    pivots = pivot_codes.choose_pivots(book)
    index, best, _ = pivot_codes.nearest(x, pivot_codes.pivot_distances(x, pivots).astype(np.float32), book, pivot_codes.pivot_distances(book, pivots))
    whole = pivot_codes.distances(x[:, None, :], book[None, :, :])
    if rows:
        assert (index == whole.argmin(axis=1)).all() and (best == whole.min(axis=1)).all()
    assert len(index) == rows


# ---------------------------------------------------------------- operator 11


def brute_print(text, k=4):
    w = H.words(H.lower(text))
    grams = [" ".join(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius=4):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_equal_brute_force_and_spark(spark):
    for _, text in H.awkward_rows():
        assert ball_hashing.fingerprint(text) == brute_print(text)
    text = "Ä tie of WORDS"   # one shingle: its own hash, the same as Spark's xxhash64
    value = spark.sql("select xxhash64('Ä tie of words') as h").first().h
    assert ball_hashing.fingerprint(text) == value % (1 << 64)
    long = " ".join(f"w{i % 977}" for i in range(150_000))
    assert ball_hashing.fingerprint(long) == brute_print(long)


def test_components_equal_brute_force(spark):
    rows = H.awkward_rows() + [(100 + i, f"{H.prose(random.Random(i // 5), 300)} end{i}") for i in range(40)] + [(None, None)]
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, print int, id string, component string").repartition(3)
    prints = [brute_print(t) for _, t in rows]
    group, low = brute_groups(prints), {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    want = sorted(((i, f"{p:016x}", low.get(g)) for (i, _), p, g in zip(rows, prints, group)), key=str)
    assert sorted((tuple(r) for r in ball_hashing.simhash_components(df).collect()), key=str) == want
    assert ball_hashing.simhash_components(df.limit(0)).collect() == []


@pytest.mark.parametrize("radius,slices", [(4, 8), (2, 8), (4, 3)])
def test_no_link_of_planted_fingerprints_is_lost(spark, monkeypatch, radius, slices):
    """Random fingerprints, chains of neighbours at exactly the radius, one dense ball; few and many slices."""
    monkeypatch.setattr(ball_hashing, "SLICE_BITS", slices)
    monkeypatch.setattr(ball_hashing, "SLICE_VARIANTS", 1 << 12)   # several sub-slices
    rng = random.Random(9)
    values = {rng.getrandbits(64) for _ in range(150)}
    for start in list(values)[:15]:
        for size in (radius, radius + 1, 1, radius):   # a step of radius + 1 links to nothing
            for b in rng.sample(range(64), size):
                start ^= 1 << b
            values.add(start)
    values |= {c ^ (1 << i) ^ (1 << j) for c in [rng.getrandbits(64)] for i in range(12) for j in range(i)} | {0, (1 << 64) - 1}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    pairs = ball_hashing.links(spark.createDataFrame([(v,) for v in signed], "print long").repartition(3), radius).collect()
    assert all(bin((r.a ^ r.b) % (1 << 64)).count("1") <= radius for r in pairs)
    place, parent = {v: i for i, v in enumerate(signed)}, list(range(len(signed)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for r in pairs:
        parent[find(place[r.a])] = find(place[r.b])
    assert H_partition([find(i) for i in range(len(signed))]) == H_partition(brute_groups(values, radius))
    with pytest.raises(ValueError):
        ball_hashing.links(spark.createDataFrame([(1,)], "print long"), 3)


@pytest.mark.parametrize("slices", [8, 11])
def test_a_dense_group_gives_few_pairs_and_none_twice(spark, monkeypatch, slices):
    """All 277 fingerprints within two flips of 23 bits of a centre: 38,226 links, each sharing up to 2,000 variants."""
    monkeypatch.setattr(ball_hashing, "SLICE_BITS", slices)
    rng = random.Random(3)
    centre, bits = rng.getrandbits(64), rng.sample(range(64), 23)
    values = sorted({centre ^ (1 << i | 1 << j) for i in bits for j in bits if i != j} | {centre ^ 1 << i for i in bits} | {centre})
    place = {v - (1 << 64) if v >> 63 else v: i for i, v in enumerate(values)}
    pairs = [(r.a, r.b) for r in ball_hashing.links(spark.createDataFrame([(v,) for v in place], "print long").repartition(3)).collect()]
    assert len(pairs) == len(set(pairs)) <= 40 * len(values)
    seen, border = set(), [0]
    near = collections.defaultdict(list)
    for a, b in pairs:
        near[place[a]].append(place[b])
        near[place[b]].append(place[a])
    while border:
        seen.update(border)
        border = [y for x in border for y in near[x] if y not in seen]
        border = sorted(set(border))
    assert len(seen) == len(values) == 277


def H_partition(labels):
    groups = collections.defaultdict(set)
    for i, g in enumerate(labels):
        groups[g].add(i)
    return {frozenset(g) for g in groups.values()}


# ---------------------------------------------------------------- operator 13


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    one = Tokenizer.from_file(queries.bpe_path())
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=queries.piece_path())


ODD = ["", None, " ", "   ", "x", "x ", "  two  spaces ", "tab\tand\nlines\r\n\n end\n", "<|endoftext|> <s> </s> <unk>", "a▁b ▁", "漢字と かな　全角 space",
       "émoji 😀😀 👩‍👩‍👧 ok", "ﬁne ½ Ⅷ İ", "nul\x00byte \x7f\x80", "é combining", "1234567890 12 3,456.78", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
       "don't we'll I'M", " nbsp line﻿bom", "x" * 5000 + " " * 300 + "ü" * 700, "кириллица и English mixed 中文 text", " lead", "\n", "�"]


def brute_alignment(text, one, two):
    """(ids_a, ids_b, groups as index ranges) by sets of end offsets; None without tokens."""
    if not text:
        return None
    alphabet = alignment.byte_alphabet()
    a = one.encode(" " + text, add_special_tokens=False)
    bytes_a = [bytes(alphabet[c] for c in t) for t in a.tokens]
    ids_b = two.encode(text)
    bytes_b = [bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [two.id_to_piece(i)]]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    ends = [[], []]
    for side, tokens in enumerate((bytes_a, bytes_b)):
        at = 0
        for t in tokens:
            at += len(t)
            ends[side].append(at)
    groups, i, j = [], 0, 0
    for e in sorted(set(ends[0]) & set(ends[1])):
        i2, j2 = ends[0].index(e, i) + 1, ends[1].index(e, j) + 1
        groups.append((i, i2, j, j2))
        i, j = i2, j2
    return a.ids, ids_b, groups, ends


def brute_counts(rows, one, two):
    docs = [brute_alignment(t, one, two) for _, t in rows]
    links = [collections.Counter((d[0][i], d[1][j]) for a, a2, b, b2 in d[2] for i in range(a, a2) for j in range(b, b2)) if d else collections.Counter()
             for d in docs]
    count = collections.Counter(p for own in links for p in own)
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for (i, _), d, own in zip(rows, docs, links):
        text = ";".join(",".join(map(str, d[0][a:a2])) + "|" + ",".join(map(str, d[1][b:b2])) for a, a2, b, b2 in d[2]) if d else ""
        out.append((i, len(d[0]) if d else 0, len(d[1]) if d else 0, len(d[2]) if d else 0, sum(own.values()),
                    sum(m for p, m in own.items() if count[p] == best[p[0]]), sum(m * count[p] for p, m in own.items()),
                    hashlib.sha256(text.encode()).hexdigest() if d else ""))
    return out


def test_alignment_counts_equal_brute_force(spark, tokenizers):
    rng = random.Random(4)
    sample = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rows = [(i, t) for i, t in enumerate(ODD)] + H.awkward_rows() + [(200 + i, t) for i, t in enumerate(rng.sample(sample, 40))]
    df = spark.createDataFrame([(i, t, 1, "p") for i, t in rows], "doc_id long, text string, row int, pairs string").repartition(3)
    want = sorted(brute_counts(rows, *tokenizers), key=str)
    assert any(w[1] == 0 and w[7] == "" for w in want) and any(w[1] > 1000 for w in want)
    for hot in (1 << 20, 50, 0):   # all pairs broadcast, some, none
        got = alignment.alignment_counts(df, queries.bpe_path(), queries.piece_path(), hot_pairs=hot)
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert alignment.alignment_counts(df.limit(0), queries.bpe_path(), queries.piece_path()).collect() == []


def test_groups_and_overlaps_of_every_document(spark, tokenizers):
    rows = [(i, t) for i, t in enumerate(ODD)]
    got = {r.doc_id: r for r in alignment.aligned(spark.createDataFrame(rows, "doc_id long, text string"), queries.bpe_path(), queries.piece_path()).collect()}
    for i, t in rows:
        d, r = brute_alignment(t, *tokenizers), got[i]
        if d is None:
            assert r.tokens_a == r.tokens_b == r.group_ends_a == r.overlap_first == []
            continue
        ids_a, ids_b, groups, (ends_a, ends_b) = d
        assert (r.tokens_a, r.tokens_b, r.group_ends_a, r.group_ends_b) == (ids_a, ids_b, [g[1] for g in groups], [g[3] for g in groups])
        starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
        for k, (lo, hi) in enumerate(zip(r.overlap_first, r.overlap_last)):
            met = [j + 1 for j in range(len(ends_b)) if starts_b[j] < ends_a[k] and ends_b[j] > starts_a[k]]
            assert (lo, hi) == (met[0], met[-1])


def test_galloping_intersection_on_random_lists():
    rng = random.Random(2)
    for lane in (1, 3, 64):
        rows = []
        for _ in range(60):
            size = rng.choice([0, 1, 5, 300])
            rows.append((sorted(rng.sample(range(1000), size)), sorted(rng.sample(range(1000), rng.choice([0, 2, 40, 700])))))
        bounds = [np.append(0, np.cumsum([len(r[s]) for r in rows])) for s in (0, 1)]
        a, b = (np.array([x for r in rows for x in r[s]], np.int64) for s in (0, 1))
        old, alignment.LANE = alignment.LANE, lane
        try:
            ia, ib = alignment.common_ends(a, bounds[0], b, bounds[1])
        finally:
            alignment.LANE = old
        want = [(bounds[0][i] + x.index(v), bounds[1][i] + y.index(v)) for i, (x, y) in enumerate(rows) for v in sorted(set(x) & set(y))]
        assert list(zip(ia.tolist(), ib.tolist())) == want


def test_links_in_chunks_are_the_same(monkeypatch):
    one, two = alignment.ByteEncoder(queries.bpe_path()), alignment.PieceEncoder(queries.piece_path())
    block = next(blocks(pa.array([t for t in ODD if t] + ["漢字" * 500])))
    x = alignment.align(block, one, two)
    whole = alignment.linked_pairs(x, 32_000, 50_257 * 32_000)
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", 37)
    for got, want in zip(alignment.linked_pairs(x, 32_000, 50_257 * 32_000), whole):
        assert (got == want).all()
