"""Operators 2, 3 and 9 against brute force, on awkward rows."""

import random

import pytest
from pyspark.sql import functions as F

from weblake.llm import decontaminate, ngram_join, repetition

from . import helpers as H

DOCS = "doc_id bigint, text string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_repetition_matches_brute_force(spark):
    rng = random.Random(5)
    rows = H.awkward_rows() + [(100 + i, " ".join(rng.choice("abc") for _ in range(rng.randrange(40)))) for i in range(60)]
    rows += [(200 + i, "\n".join(rng.choice(["", " ", "x y", "x  y", "long line of words here"]) for _ in range(8))) for i in range(20)]
    got = repetition.repetition_rules(spark.createDataFrame(rows, DOCS).withColumn("n_words", F.lit("clash")), min_words=4)
    for r in got.collect():
        match = [H.repetition(t, 4) for d, t in rows if d == r.doc_id]
        assert tuple(r)[1:8] in match
        n = r.n_words
        assert r.base_failed == (n < 50 or 100 * r.n_repeat_words > 50 * n)
        assert r.kept == (not r.base_failed and 100 * r.n_covered_words <= 30 * n and r.longest_repeat <= 60)
    assert got.count() == len(rows)


def test_repetition_of_a_very_long_text_and_spans(spark):
    rng = random.Random(6)
    part = H.prose(rng, 200_000, 10**9)
    docs = spark.createDataFrame([(1, part + " " + part), (2, None)], DOCS)
    first = repetition.repetition_rules(docs).where("doc_id = 1").first()
    assert (first.n_words, first.longest_repeat, first.n_covered_words, first.kept) == (400_000, 200_000, 400_000, False)
    short = spark.createDataFrame([(1, "a b c d x a b c d y b c d"), (2, "")], DOCS)
    spans = rows_of(repetition.repeated_spans(short, min_words=3))
    assert spans == [(1, 0, 4, "a b c d"), (1, 10, 3, "b c d"), (1, 5, 4, "a b c d")]


def test_repetition_of_an_empty_table(spark):
    assert repetition.repetition_rules(spark.createDataFrame([], DOCS)).count() == 0


ITEMS = [(1, None), (2, ""), (3, "alpha beta"), (4, "Alpha, BETA!"), (5, " ".join(f"q{i}" for i in range(20))), (5, "alpha beta"),
         (None, "nameless item text"), (11, "solo"), (12, " ".join(f"q{i}" for i in range(13)))]


def planted(seed=2):
    rng = random.Random(seed)
    rows = H.awkward_rows()
    for i in range(40):
        at, size = rng.randrange(8), rng.choice([12, 13, 14, 20])
        passage = " ".join(f"Q{j}" for j in range(at, min(at + size, 20)))
        rows.append((300 + i, f"{H.prose(rng, rng.randrange(30))} {passage}; {rng.choice(['alpha-beta', 'solo', 'nameless item text', ''])} {H.prose(rng, rng.randrange(300))}"))
    return rows


@pytest.mark.parametrize("chunk", [1 << 20, 40])
def test_decontamination_matches_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", chunk)   # the small one makes several passes
    rows, items = planted(), ITEMS
    docs = spark.createDataFrame(rows, DOCS).withColumn("items", F.lit("clash")).withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(9))
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in decontaminate.contamination(docs, bench).collect()), key=str)
    want = []
    for d, t in rows:
        n, hit, found = H.contamination(t, items)
        want.append((d, n, hit, found, hit > 0 and 20 * hit >= n))
    assert got == sorted(want, key=str)
    clean = decontaminate.decontaminate(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not w[4] for w in want)


def test_tables_of_a_large_benchmark_and_copies_of_one_item(spark, monkeypatch):
    rng = random.Random(3)
    items = [(i, H.prose(rng, 9_000, 60_000)) for i in range(20)] + [(100 + i, "x " * 30 + H.prose(random.Random(1), 500)) for i in range(200)]
    size = sum(len(t) for _, t in items)
    matchers = decontaminate.build(items, 13)
    assert len(matchers) == 1 and matchers[0].nbytes < 25 * size   # 8 MB of text: under 200 MB
    assert len(matchers[0].first) < 20 * 9_000 + 600 and matchers[0].shift.dtype.itemsize == 1   # the copies' windows once
    docs = [(1, "w " + " ".join(items[3][1].split()[700:720])), (2, H.prose(random.Random(1), 500)), (3, "nothing here"), (None, items[0][1])]
    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", size // 4)
    found = decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items + items[:5], "item_id bigint, text string"))
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found.collect()}
    assert got[1] == (21, 20, ["3"]) and got[2] == (500, 500, [str(100 + i) for i in range(200)]) and got[3] == (2, 0, [])
    assert got[None] == (9_000, 9_000, ["0"])


def test_decontamination_of_long_texts_and_empty_tables(spark):
    passage = " ".join(f"q{i}" for i in range(20))
    long_text = "filler words " * 150_000 + passage + " filler" * 150_000
    docs = spark.createDataFrame([(1, long_text), (2, passage)], DOCS)
    bench = spark.createDataFrame(ITEMS[4:5], "item_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    assert (got[1].n_hit, got[1].contaminated, got[2].n_hit, got[2].contaminated) == (20, False, 20, True)
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0 or contaminated").count() == 0
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_jaccard_components_match_brute_force(spark):
    rng = random.Random(8)
    rows = H.awkward_rows()
    shared = H.prose(rng, 60, 10**6)
    for i in range(60):   # documents that share a long passage, and chains of near copies
        rows.append((1000 + i, f"{H.prose(rng, rng.randrange(5, 60), 10**6)} {shared} {H.prose(rng, rng.randrange(5, 60), 10**6)}"))
    chain = H.prose(rng, 100, 10**6).split()
    for i in range(30):
        chain[rng.randrange(100)] = f"c{i}"
        rows.append((2000 + i, " ".join(chain)))
    docs = spark.createDataFrame(rows, DOCS)
    extra = docs.withColumns({c: F.lit(1) for c in ("sig", "n", "label", "n_shingles", "component_id", "id", "gram")})
    want = H.jaccard_components(rows)
    assert rows_of(ngram_join.jaccard_components(extra)) == want
    kept = ngram_join.one_per_component(docs.withColumn("row", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "row"]
    roots = {c for _, _, c in want}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(roots, key=str)
    mixed = spark.createDataFrame([(8, "a b c d e f"), (7, "a b c d e f"), (8, "g h i j k l"), (8, "g h i j k l"), (None, "a b c d e f"),
                                   (None, None), (9, None), (9, "")], DOCS)   # one id with two texts, equal rows, no words
    assert rows_of(ngram_join.one_per_component(mixed)) == sorted([(7, "a b c d e f"), (8, "g h i j k l"), (None, None), (9, None)], key=str) or \
        rows_of(ngram_join.one_per_component(mixed)) == sorted([(7, "a b c d e f"), (8, "g h i j k l"), (None, None), (9, "")], key=str)


def test_common_ngrams_move_work_not_results(spark, monkeypatch):
    rng = random.Random(9)
    base = H.prose(rng, 150, 10**6).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 120):
        own = list(base)
        for _ in range(rng.randrange(1, 9)):
            own[rng.randrange(len(own))] = f"n{i}-{rng.randrange(99)}"
        rows.append((i, " ".join(own)))
    docs, want = spark.createDataFrame(rows, DOCS), H.jaccard_components(rows)
    for local in (3, 24, 10**6):
        monkeypatch.setattr(ngram_join, "HOT_LOCAL", local)
        assert rows_of(ngram_join.jaccard_components(docs)) == want


def test_jaccard_of_long_texts_and_empty_tables(spark):
    rng = random.Random(10)
    text = H.prose(rng, 250_000, 10**9)
    docs = spark.createDataFrame([(5, text), (6, text + " one more"), (7, "short")], DOCS)
    assert rows_of(ngram_join.jaccard_components(docs)) == [(5, 249_996, 5), (6, 249_998, 5), (7, 1, 7)]
    assert ngram_join.jaccard_components(docs.limit(0)).count() == 0
    assert ngram_join.one_per_component(docs.limit(0)).count() == 0


def test_different_sets_with_one_signature_are_told_apart(spark, monkeypatch):
    rng = random.Random(11)
    base = [H.prose(rng, 60, 10**6) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)] + [(50 + i, t) for i, t in enumerate(base[:5])] + [(90, base[3] + " x"), (91, ""), (92, None)]
    whole = ngram_join.signatures
    monkeypatch.setattr(ngram_join, "signatures", lambda hashes, bounds, second=False: whole(hashes, bounds, second) if second else whole(hashes, bounds) % 3)
    assert rows_of(ngram_join.jaccard_components(spark.createDataFrame(rows, DOCS))) == H.jaccard_components(rows)
