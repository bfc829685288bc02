"""Operators 4, 7 and 10: held-out quality, brute force for Viterbi and rates, awkward rows."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weblake.llm import language, mixing, queries, toxicity

from . import helpers as H

DOCS = "doc_id bigint, text string"
SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_matches_all_labelings(seed):
    rng = np.random.default_rng(seed)
    counts = np.array([0, 1, 5, 3, 0, 7])
    bounds = np.concatenate([[0], np.cumsum(counts)])
    scores = rng.normal(0, 3, (bounds[-1], 3)).astype(np.float32)
    got = language.viterbi(scores, bounds, 2.5)

    def value(labels, own):
        return sum(own[i, x] for i, x in enumerate(labels)) - 2.5 * sum(a != b for a, b in zip(labels, labels[1:]))

    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            best = max(value(x, scores[a:b]) for x in itertools.product(range(3), repeat=b - a))
            assert value(got[a:b].tolist(), scores[a:b]) == pytest.approx(best, abs=1e-4)


@pytest.fixture(scope="module")
def model(spark):
    rows = []
    for i in range(200):
        rows += [(i, "the cat and the dog with this house", "en"), (1000 + i, "der hund und die katze mit dem haus", "de"),
                 (2000 + i, "собака и кошка в этом доме", "ru"), (3000 + i, None, "en"), (4000 + i, "no label", None)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("h", F.lit(1))
    return language.fit(labelled)


def test_language_of_awkward_rows_and_spans(spark, model):
    assert model.languages == ["de", "en", "ru"]
    rows = [(1, None), (2, ""), (3, " 12 !? 漢"), (4, "1234 --"), (5, "die katze und der hund"), (5, "die katze und der hund"),
            (6, "собака кошка"), (7, "the dog and the cat with this house " * 3 + "собака и кошка в этом доме " * 5), (8, "x" * 300_000),
            (9, "the house and this cat " * 100_000)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("lang_pred", F.lit("clash"))
    got = sorted(((r.doc_id, r.lang_pred, r.score, r.n_spans) for r in language.predict(docs, model).collect()), key=str)
    by_id = {r[0]: r for r in got}
    assert len(got) == len(rows)
    assert by_id[1][1:3] == by_id[2][1:3] == by_id[4][1:3] == ("und", 0.0)
    assert by_id[3][1] in model.languages           # a letter of a script nobody writes in
    assert (by_id[5][1], by_id[6][1], by_id[9][1]) == ("de", "ru", "en")
    assert by_id[7][3] == 2 and by_id[7][1] == "ru" and 0.5 < by_id[7][2] < 0.9
    spans = sorted(tuple(r)[:4] for r in language.language_spans(docs.where("doc_id = 7"), model).collect())
    assert [(s[0], s[2], s[3]) for s in spans] == [(7, 24, "en"), (7, 30, "ru")]


def test_language_without_labels(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    none = language.fit(empty)
    assert [tuple(r)[1:3] for r in language.predict(spark.createDataFrame([(1, "words")], DOCS), none).collect()] == [("und", 0.0)]
    assert language.predict(spark.createDataFrame([], DOCS), none).count() == 0


def test_language_held_out_accuracy(spark):
    got = queries.QUERIES["op10_language_spans"](spark, SF).where("held_out")
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    assert got.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.99


def test_toxicity_held_out_quality(spark):
    got = queries.QUERIES["op4_convolutional_toxicity"](spark, SF)
    joined = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    rates = {r.toxic: r.p for r in joined.groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()}
    assert rates[1] > 0.85 and rates[0] < 0.05
    bad = got.where("score < 0 or score > 1 or predicted <> int(score >= 0.7)")
    assert bad.count() == 0


def plain_loss(model, docs, y, keep):
    """Loss by the definition, one window and one filter at a time, in 64 bits."""
    size, total = toxicity.FILTERS, 0.0
    for doc, label, own in zip(docs, y, keep):
        z = float(model.out_bias)
        for f in range(len(model.bias)):
            weight = model.filters[f // size][:, :, f % size].astype(np.float64)
            vectors = [model.embed[a].astype(np.float64) + model.embed[b] for a, b in doc]
            windows = [sum(float(v @ w) for v, w in zip(vectors[i:], weight)) for i in range(len(doc))]
            z += max(0.0, max(windows, default=0.0) + float(model.bias[f])) * float(own[f]) * float(model.out[f])
        total += math.log1p(math.exp(z)) - float(label) * z
    squares = sum((w.astype(np.float64) ** 2).sum() for w in [*model.filters, model.out])
    return total / len(docs) + toxicity.DECAY / 2 * squares


def test_toxicity_logits_and_gradients_match_the_definition():
    rng = np.random.default_rng(5)
    dim, size = toxicity.DIM, toxicity.FILTERS
    model = toxicity.Model(rng.normal(0, 1, (40, dim)), [rng.normal(0, 0.3, (w, dim, size)) for w in toxicity.WIDTHS],
                           rng.normal(0, 0.3, len(toxicity.WIDTHS) * size), rng.normal(0, 0.3, len(toxicity.WIDTHS) * size), 0.1)
    docs = [[(int(rng.integers(20)), 20 + int(rng.integers(20))) for _ in range(n)] for n in (6, 0, 1, 2, 9)]
    ids = np.array([pair for doc in docs for pair in doc])
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    y, keep = np.array([1, 0, 0, 1, 1], np.float32), (rng.random((5, len(model.bias))) < 0.5) * 2.0
    for doc, z in zip(docs, model.logits(ids, bounds)):
        own = plain_loss(model, [doc], [0], np.ones((1, len(model.bias)))) - toxicity.DECAY / 2 * sum((w ** 2).sum() for w in [*model.filters, model.out])
        assert z == pytest.approx(math.log(math.expm1(own)), abs=1e-4)
    d_last, d_out, d_bias, d_filters, touched, moved = toxicity.gradients(model, ids, bounds, y, keep)
    d_embed = np.zeros_like(model.embed)
    np.add.at(d_embed, touched, moved)

    def slope(array, at):
        kept, values = array[at], []
        for step in (1e-6, -1e-6):
            array[at] = kept + step
            values.append(plain_loss(model, docs, y, keep))
        array[at] = kept
        return (values[0] - values[1]) / 2e-6

    for array, got in [(model.embed, d_embed), (model.bias, d_bias), (model.out, d_out), *zip(model.filters, d_filters)]:
        for flat in rng.choice(array.size, 25, replace=array.size < 25):
            at = np.unravel_index(flat, array.shape)
            assert got[at] == pytest.approx(slope(array, at), abs=2e-5)
    rest = [plain_loss(toxicity.Model(model.embed, model.filters, model.bias, model.out, 0.1 + s), docs, y, keep) for s in (1e-6, -1e-6)]
    assert d_last == pytest.approx((rest[0] - rest[1]) / 2e-6, abs=2e-5)


def test_toxicity_learns_from_bounded_text(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["idiot", "stupid"] if i % 2 else ["nice", "day"]) for _ in range(20)), i % 2) for i in range(120)]
    rows += [(1000 + i, "idiot " * 200_000 if i % 2 else "day " * 200_000, i % 2) for i in range(4)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 100_000)
    taken, kept = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda found, y: (taken.extend(map(len, found)), kept(found, y))[1])
    fitted = toxicity.fit(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    assert taken and sum(taken) * 4 <= 2 * 100_000
    scores = {r.doc_id: r[toxicity.SCORE] for r in toxicity.scored(table, fitted).collect()}
    assert all((scores[i] >= toxicity.CUT) == (toxic == 1) for i, _, toxic in rows)


def test_language_learns_from_long_and_repeated_rows_in_parts(spark):
    rows = [(1, "the cat and the dog " * 100_000, "en"), (2, "der hund und die katze", "de"), (3, "la casa y el perro", "es"), (None, "the", "xx")]
    labelled = spark.createDataFrame(rows + [(2, "der hund und die katze", "de")] * 300, "doc_id bigint, text string, lang string")
    once, spread = language.fit(spark.createDataFrame(rows[:3], labelled.schema).coalesce(1)), language.fit(labelled.repartition(7))
    assert once.languages == spread.languages == ["de", "en", "es"]
    assert np.array_equal(once.table, spread.table) and np.array_equal(once.writes, spread.writes)


def test_toxicity_of_awkward_rows(spark):
    rng = random.Random(4)
    rows = [(i, H.prose(rng, 40) + (f" nasty{i % 3} " if i % 4 == 0 else " ") + H.prose(rng, 40)) for i in range(2000)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(2000)] + [(0, 1), (None, 1), (9999, 1), (5, None)], "doc_id bigint, toxic int")
    train = spark.createDataFrame(rows + rows[:5], DOCS)
    fitted = toxicity.fit(train, labels.withColumn("text", F.lit("clash")))
    probe = [(1, None), (2, ""), (3, H.prose(rng, 60)), (4, H.prose(rng, 30) + " NASTY1, " + H.prose(rng, 30)), (4, "x"),
             (5, H.prose(rng, 200_000) + " nasty2 " + H.prose(rng, 100_000))]
    docs = spark.createDataFrame(probe, DOCS).withColumns({"label": F.lit(1), toxicity.SCORE: F.lit(5.0)})
    got = toxicity.scored(docs, fitted).orderBy("doc_id", F.length("text")).collect()
    scores = [r[toxicity.SCORE] for r in got]
    assert len(scores) == len(probe) and all(0 <= s <= 1 for s in scores)
    assert scores[0] == scores[1] < 0.7 and scores[2] < 0.7 and scores[4] >= 0.7 and scores[5] >= 0.7, scores
    kept = toxicity.drop_toxic(docs.drop(toxicity.SCORE), fitted)
    assert kept.columns == ["doc_id", "text", "label"] and kept.where("doc_id = 5").count() == 0
    assert toxicity.fit(train, labels.where("toxic = 1")) is None
    assert toxicity.fit(train.limit(0), labels) is None
    assert [r[toxicity.SCORE] for r in toxicity.scored(docs, None).collect()] == [0.0] * len(probe)
    assert toxicity.scored(docs.limit(0), fitted).count() == 0


def test_toxicity_thresholds_rest_on_all_labelled_rows(spark, monkeypatch):
    """A small training sample, as at any corpus that has many more labels: the thresholds still see every other row."""
    monkeypatch.setattr(toxicity, "SAMPLE_DOCS", 60)
    rng = random.Random(15)
    rows = []
    for i in range(1500):
        toxic, german = int(i % 3 == 0), i % 10 == 1 or i % 10 == 9
        filler = "der hund und die katze mit dem haus" if german else "the dog and the cat with this house"
        marks = "nasty " * (rng.randrange(1, 3) if toxic else int(rng.random() < 0.1)) + ("stark " if german and not toxic else "")
        rows.append((i, f"{filler} {marks}{H.prose(rng, 30)} {filler}", toxic, "de" if german else "en"))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int, lang string")
    docs, seen, kept = table.select("doc_id", "text"), [], toxicity.calibrate
    monkeypatch.setattr(toxicity, "calibrate", lambda model, *args: seen.append(args) or kept(model, *args))
    fitted = toxicity.fit(docs.unionByName(docs.limit(100)), table.select("doc_id", "toxic"))
    en, de = toxicity.LANGUAGES.index("en"), toxicity.LANGUAGES.index("de")
    assert fitted.shift[en] != fitted.shift[de]
    (counts,), = seen
    assert counts.sum() == len(rows) - 2 * 48   # 60 of a class sampled, four fifths of them learned from
    assert counts[de].sum() > 200 and counts[de, 1].sum() > 60


def test_mixing_matches_brute_force(spark):
    rng = random.Random(12)
    rows = [(i, (H.prose(rng, rng.randrange(1, 200)) if i % 3 else "#$% " * rng.randrange(1, 60))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "word " * 50_000), (7, "a repeated id")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"rate": F.lit(1), "copies": F.lit(2)})
    labels = spark.createDataFrame([(i, "low" if i % 3 == 0 else "high") for i in range(0, 300, 2)] + [(4, "zzz"), (6, None), (9, "low"), (99999, "high")],
                                   "doc_id bigint, domain string")
    weights = {"high": 0.6, "low": 0.4}
    rates = mixing.fit(docs, labels, weights)
    got = mixing.rated(docs, rates, weights).collect()
    assert len(got) == len(rows)
    n = np.array([r.n_tokens for r in got], float)
    p = np.array([[r.p_high, r.p_low] for r in got])
    assert sorted(n.astype(int).tolist()) == sorted(len(H.words(t)) for _, t in rows)
    assert np.allclose(p.sum(axis=1), 1)
    present, share = p.T @ n, np.array([0.6, 0.4])
    targets = max(present / share) * share
    # brute force: plain projected gradient over every document for very long
    r, whole = np.ones(len(n)), n.sum()
    for _ in range(200_000):
        rho = (p.T @ (n * r) - targets) / whole
        new = np.maximum(0, r - (p @ rho + mixing.PULL * (r - 1)) / (1 + mixing.PULL))
        if np.abs(new - r).max() < 1e-9:
            break
        r = new
    fitted = np.array([x.rate for x in got])
    assert np.abs(p.T @ (n * fitted) - p.T @ (n * r)).max() / whole < 2e-3
    assert np.abs(p.T @ (n * fitted) - targets).max() / whole < 5e-3
    for x in got:
        assert x.copies in (math.floor(x.rate), math.floor(x.rate) + 1)
    taken = mixing.mixed(docs, rates)
    assert taken.columns == docs.columns and taken.count() == sum(x.copies for x in got)


def test_pipeline_mixing_keeps_every_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = corpus_pipeline.mix_to_weights(spark, docs, SF)
    assert docs.join(mixed, "doc_id", "left_anti").count() == 0
    rows = queries.QUERIES["op7_soft_mixing"](spark, SF)
    assert rows.where("rate < 1 or copies < 1").count() == 0


def test_mixing_from_rate_one_meets_the_weights(spark):
    docs, weights = spark.read.parquet(f"{SF}/documents.parquet"), {"high": 0.6, "low": 0.4}
    got = mixing.rated(docs, mixing.fit(docs, queries.quality_domains(spark, SF), weights, least=1.0), weights)
    r = got.agg(F.min("rate"), F.min("copies"), *[F.sum(F.col("n_tokens") * F.col("rate") * F.col(f"p_{d}")) for d in ("high", "low")]).first()
    assert r[0] >= 1 and r[1] >= 1
    assert abs(r[2] / (r[2] + r[3]) - 0.6) < 5e-3


def test_mixing_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], DOCS)
    labels = spark.createDataFrame([], "doc_id bigint, domain string")
    weights = {"a": 1.0, "b": 1.0}
    got = mixing.rated(docs, mixing.fit(docs, labels, weights), weights).collect()
    assert [(r.p_a, r.p_b) for r in got] == [(0.5, 0.5)] * 2 and all(abs(r.rate - 1) < 1e-6 for r in got)
    empty = docs.limit(0)
    assert mixing.mixed(empty, mixing.fit(empty, labels, weights)).count() == 0


def test_mixing_from_rate_one_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], DOCS)
    labels = spark.createDataFrame([], "doc_id bigint, domain string")
    uneven = {"a": 0.9, "b": 0.1}   # no repetition meets these weights: the total is not raised for them
    assert all(1 <= r.rate < 5 for r in mixing.rated(docs, mixing.fit(docs, labels, uneven, least=1.0), uneven).collect())
    empty = docs.limit(0)
    assert mixing.mixed(empty, mixing.fit(empty, labels, uneven, least=1.0)).count() == 0


def test_mixing_can_cut_and_stays_nonnegative(spark):
    rng = random.Random(13)
    rows = [(i, H.prose(rng, 50) if i % 2 else "#$% " * 50) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, "high" if i % 2 else "low") for i in range(200)], "doc_id bigint, domain string")
    got = mixing.rated(docs, mixing.fit(docs, labels, {"high": 1.0, "low": 1e-9}, budget=5000.0), {"high": 1.0, "low": 1e-9})
    assert got.where("rate < 0").count() == 0
    assert got.where("p_low > 0.9").agg(F.max("rate")).first()[0] < 0.05


def test_mixing_reports_weights_that_are_not_met(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), queries.quality_domains(spark, SF)
    with pytest.warns(UserWarning, match="not met after 2 steps"):
        mixing.fit(docs, labels, {"high": 0.3, "low": 0.7}, max_steps=2)
