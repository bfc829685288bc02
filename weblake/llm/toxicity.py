"""Toxicity: a convolutional text classifier trained in numpy (operator 4).

A word's vector is the sum of two hashed embeddings (the word, and its first bytes, so
that inflected forms share one). Filters of several widths run over a document's words,
each filter's maximum over the whole document is kept (max pooling), and a logistic layer
gives the logit. Gradients flow to the maximal windows only, which makes training cheap.

Training takes at most ``SAMPLE_DOCS`` labelled documents of each class (those with the
smallest hashes: a documented bound) but every fifth of them, and of these in the same order only
as many as have ``SAMPLE_BYTES`` of text together; their word hashes, not their texts, reach the
driver. All other labelled documents, however many, are scored on Spark and
calibrate a threshold for each language from counts by language, label and logit bin (the least
share missed plus ``ALARM`` times the share of clean documents flagged), so that a calibrated score of ``CUT`` means "at the language's threshold". A language with fewer than
``LEAST`` such rows of a class is filled up to ``LEAST`` with the distribution of all
languages; one without any has the threshold of all. The language of a text is read off its
own function words; no column but the text enters a score.

Null and empty texts have no words and get the score of the bias alone; every score lies
in 0..1. Without labelled rows of both classes every document scores 0. Repeated rows are
scored each for itself, a document that occurs repeatedly trains once, labels without a
document are unused; extra columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage, staging
from .words import ALNUM_WORD, LOWER, U64, Words, blocks, mix, span_hashes, split

SAMPLE_DOCS = 4000
SAMPLE_BYTES = 64 << 20   # text of a class's training documents together
BITS, DIM, FILTERS, WIDTHS = 15, 12, 12, (1, 2, 3)
STEM = 5               # bytes of a word that its second embedding hashes
ALARM = 2              # what a share of clean documents flagged weighs against the same share of toxic ones missed
CUT = 0.7              # calibrated scores from here on are toxic
LEAST = 25             # rows of a class from which a language's threshold rests on its own rows alone
LIMIT, STEPS = 30, 32  # logits are clipped to -LIMIT..LIMIT and counted in STEPS bins for each unit
BLOCK = 1 << 20
EPOCHS, LEAST_STEPS, BATCH, RATE, DECAY = 4, 400, 32, 0.01, 1e-3

# Frequent function words, by which a text's language is told for calibration.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as was on be by this are",
    "fr": "le la les des du est et un une dans que qui pour sur pas",
    "de": "der die das und ist ein eine nicht mit von zu den auf sich",
    "es": "el los las del que en una por con para como es se lo",
}
LANGUAGES = ["", *sorted(FUNCTION_WORDS)]


def _hashes(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words])
    return span_hashes(np.frombuffer(b"".join(words), np.uint8), np.append(0, ends[:-1]), ends)


def _language_table() -> tuple[np.ndarray, np.ndarray]:
    pairs = [(w, LANGUAGES.index(c)) for c, ws in FUNCTION_WORDS.items() for w in ws.split()]
    keys = _hashes([w.encode() for w, _ in pairs])
    order = np.argsort(keys, kind="stable")
    return keys[order], np.array([c for _, c in pairs])[order]


def encode(block) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, their embedding rows [word, 2], and each row's language number."""
    data = LOWER[block.data]
    words = split(block, ALNUM_WORD, lower=True)
    stems = span_hashes(data, words.starts, np.minimum(words.ends, words.starts + STEM))
    ids = np.stack([words.hashes >> U64(64 - BITS), (mix(stems) >> U64(64 - BITS)) + U64(1 << BITS)], axis=1).astype(np.int32)
    keys, owner = _language_table()
    at = np.minimum(np.searchsorted(keys, words.hashes), len(keys) - 1)
    known = keys[at] == words.hashes
    size = len(LANGUAGES)
    votes = np.bincount(words.rows[known] * size + owner[at[known]], minlength=block.n * size).reshape(block.n, size)
    return words, ids, votes.argmax(axis=1)


@dataclass
class Model:
    embed: np.ndarray
    filters: list[np.ndarray]      # per width: [width, DIM, FILTERS]
    bias: np.ndarray               # [widths * FILTERS]
    out: np.ndarray
    out_bias: float
    shift: dict[int, float] = field(default_factory=dict)   # language number -> logit shift

    def pool(self, ids: np.ndarray, bounds: np.ndarray, where: bool = False):
        """Maximum of every filter over each row [row, filter] (and the window it is at)."""
        n, rows = len(ids), len(bounds) - 1
        full = np.flatnonzero(np.diff(bounds) > 0)
        best = np.zeros((rows, len(self.bias)), dtype=np.float32)
        spot = np.zeros((rows, len(self.bias)), dtype=np.int64)
        if not n:
            return (best, spot) if where else best
        vectors = self.embed[ids[:, 0]] + self.embed[ids[:, 1]]
        left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
        for k, weight in enumerate(self.filters):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            values = vectors @ weight[0]
            for j in range(1, len(weight)):
                inside = (left[:n - j] > j)[:, None]
                values[:n - j] += (vectors[j:] @ weight[j]) * inside
            best[full, cols] = np.maximum.reduceat(values, bounds[:-1][full], axis=0)
            if where:
                for r in full.tolist():
                    spot[r, cols] = bounds[r] + values[bounds[r]:bounds[r + 1]].argmax(axis=0)
        return (best, spot) if where else best

    def logits(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return (np.maximum(self.pool(ids, bounds) + self.bias, 0) * self.out).sum(axis=1) + self.out_bias   # a row's sum does not depend on its block

    def scores(self, ids, bounds, languages) -> np.ndarray:
        moved = np.array([self.shift.get(c, 0.0) for c in range(len(LANGUAGES))])[languages]
        return 1 / (1 + np.exp(-np.clip(self.logits(ids, bounds).astype(np.float64) + moved, -LIMIT, LIMIT)))


class _Adam:
    def __init__(self, shape):
        self.m, self.v, self.t = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0

    def step(self, grad, rate):
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.001 * (grad * grad - self.v)
        return rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def gradients(model: Model, ids: np.ndarray, bounds: np.ndarray, y: np.ndarray, keep: np.ndarray):
    """Of the mean cross-entropy plus ``DECAY`` / 2 times the squared filters and output weights, hidden
    units being multiplied by ``keep``: for the output's bias and weights, the hidden bias, the filters,
    and the embedding rows touched with what moves each."""
    pooled, spot = model.pool(ids, bounds, where=True)
    hidden = pooled + model.bias
    active = (hidden > 0) * keep
    relu = hidden * active
    p = 1 / (1 + np.exp(-np.clip(relu @ model.out + model.out_bias, -30, 30)))
    d = ((p - y) / len(y)).astype(np.float32)
    dh = d[:, None] * model.out * active
    d_bias = dh.sum(axis=0)
    dh[np.diff(bounds) == 0] = 0   # no word, no window
    d_filters, touched, moved = [], [np.zeros(0, np.int64)], [np.zeros((0, DIM), np.float32)]
    for k, weight in enumerate(model.filters):
        cols = slice(k * FILTERS, (k + 1) * FILTERS)
        g, at = dh[:, cols], spot[:, cols]
        grad = DECAY * weight
        for j in range(len(weight)):
            to = at + j
            inside = to < bounds[1:][:, None]
            to = np.where(inside, to, 0)
            vec = model.embed[ids[to, 0]] + model.embed[ids[to, 1]]           # [row, filter, DIM]
            gi = g * inside
            grad[j] += np.einsum("rf,rfd->df", gi, vec)
            step = gi[:, :, None] * weight[j].T[None]
            live = gi != 0
            for col in (0, 1):
                touched.append(ids[to[live], col])
                moved.append(step[live])
        d_filters.append(grad)
    return np.float32(d.sum()), relu.T @ d + DECAY * model.out, d_bias, d_filters, np.concatenate(touched), np.concatenate(moved)


def train(rows: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Fit by Adam on balanced mini-batches; embeddings update where the maximal windows are.

    Embeddings start near zero, so words never met in training hardly move a maximum."""
    rng = np.random.default_rng(seed)
    model = Model(rng.normal(0, 0.01, (2 << BITS, DIM)).astype(np.float32),
                  [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                  np.zeros(len(WIDTHS) * FILTERS, np.float32), rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)
    dense = [_Adam(f.shape) for f in model.filters]
    bias_opt, out_opt, last_opt, square = _Adam(model.bias.shape), _Adam(model.out.shape), _Adam(()), np.full(2 << BITS, 1e-6, np.float32)
    classes = [np.flatnonzero(labels == c) for c in (0, 1)]
    steps = max(max(len(classes[0]), len(classes[1])) * 2 // BATCH + 1, LEAST_STEPS // EPOCHS)
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch)
        for _ in range(steps):
            pick = np.concatenate([rng.choice(c, BATCH // 2) for c in classes])
            ids, bounds = _flat([rows[i] for i in pick])
            y = labels[pick].astype(np.float32)
            keep = (rng.random((BATCH, len(model.bias))) < 0.5).astype(np.float32) * 2   # dropout
            d_last, d_out, d_bias, d_filters, touched, moved = gradients(model, ids, bounds, y, keep)
            for k, grad in enumerate(d_filters):
                model.filters[k] -= dense[k].step(grad, rate)
            if len(touched):
                spots, inverse = np.unique(touched, return_inverse=True)
                total = np.stack([np.bincount(inverse, weights=moved[:, c], minlength=len(spots)) for c in range(DIM)], axis=1)
                square[spots] += (total * total).mean(axis=1)
                model.embed[spots] -= (5 * rate * total / np.sqrt(square[spots])[:, None]).astype(np.float32)
            model.bias -= bias_opt.step(d_bias, rate)
            model.out -= out_opt.step(d_out, rate)
            model.out_bias -= float(last_opt.step(d_last, rate))
    return model


def _threshold(clean: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the least share of toxic documents missed plus ``ALARM`` times the share of
    clean documents flagged (the middle of the widest best range)."""
    filled = np.flatnonzero(clean + toxic)
    edges = np.arange(filled[0], filled[-1] + 2)
    miss = np.append(0, np.cumsum(toxic))[edges] / toxic.sum()
    alarm = 1 - np.append(0, np.cumsum(clean))[edges] / clean.sum()
    best = edges[miss + ALARM * alarm <= (miss + ALARM * alarm).min() + 1e-9]
    widest = max(np.split(best, np.flatnonzero(np.diff(best) > 1) + 1), key=len)
    return (widest[0] + widest[-1]) / 2 / STEPS - LIMIT


def calibrate(model: Model, counts: np.ndarray) -> None:
    """Set the logit shift of each language from its rows [language, label, logit bin]."""
    target = np.log(CUT / (1 - CUT))
    every = counts.sum(axis=0)
    both = every.sum(axis=1).all()
    for c in range(len(LANGUAGES)):
        missing = np.maximum(0, LEAST - counts[c].sum(axis=1, keepdims=True))
        model.shift[c] = target - _threshold(*(counts[c] + missing * (every / every.sum(axis=1, keepdims=True)))) if both else 0.0


def labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """One row (id, label) of each labelled id."""
    return labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label")).groupBy("__id").agg(F.max("label").alias("label"))


def training_ids(rows: DataFrame) -> DataFrame:
    """At most ``SAMPLE_DOCS`` labelled ids a class: id, label, rank."""
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    hashed = rows.withColumn("h", F.pmod(F.xxhash64("__id", F.lit("toxicity")), F.lit(1 << 30)))
    near = hashed.join(F.broadcast(counts), "label").where(   # two rows: spares the ranking all but about twice the sample
        F.col("h") * F.col("n") <= F.lit(2 * SAMPLE_DOCS * (1 << 30)))
    ranked = near.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("h", "__id")))
    return ranked.where(F.col("r") <= SAMPLE_DOCS).select("__id", "label", "r")   # at most 2 * SAMPLE_DOCS rows


def label_counts(docs: DataFrame, rows: DataFrame, learned: DataFrame, model: Model, id_col: str, text_col: str) -> np.ndarray:
    """Labelled documents by [learned from or not, language, label, logit bin]. Only ids, languages and bins are shuffled."""
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([texts.schema["__id"], T.StructField("language", T.LongType()), T.StructField("bin", T.LongType())])

    def run(batches):
        own = shared.value
        for batch in batches:
            for block in blocks(batch.column(1), BLOCK):
                words, ids, languages = encode(block)
                spots = np.floor((np.clip(own.logits(ids, words.bounds).astype(np.float64), -LIMIT, LIMIT) + LIMIT) * STEPS)
                yield pa.record_batch([batch.column(0).slice(block.lo, block.n), pa.array(languages.astype(np.int64)),
                                       pa.array(spots.astype(np.int64))], names=["__id", "language", "bin"])

    once = texts.mapInArrow(run, schema).groupBy("__id").agg(F.min(F.struct("language", "bin")).alias("x"))   # a repeated document counts once
    known = once.join(rows, "__id").join(F.broadcast(learned.select("__id", F.lit(1).alias("learned"))), "__id", "left")
    counts = np.zeros((2, len(LANGUAGES), 2, 2 * LIMIT * STEPS + 1))
    for r in known.groupBy(F.coalesce("learned", F.lit(0)), "x.language", "label", "x.bin").count().collect():   # at most one row a cell
        counts[r[0], r[1], r[2], r[3]] = r[4]
    return counts


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """Train on a sample of the labelled documents, calibrate on all others; None without rows of both classes."""
    def words(batches):
        for batch in batches:
            for block in blocks(batch.column(2), BLOCK):
                found, ids, _ = encode(block)
                yield pa.record_batch([batch.column(0).slice(block.lo, block.n), batch.column(1).slice(block.lo, block.n),
                                       pa.array([ids[a:b].astype(np.uint16).tobytes() for a, b in zip(found.bounds[:-1], found.bounds[1:])], pa.binary())],
                                      names=["r", "label", "ids"])

    rows = labelled(labels, id_col, label_col)
    with staging(docs.sparkSession):
        chosen = stage(training_ids(rows), "training_ids")
        texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
        found = stage(texts.join(F.broadcast(chosen), "__id").groupBy("__id", "label", "r").agg(F.min("text").alias("text")), "training_texts")
        so_far = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).over(Window.partitionBy("label").orderBy("r"))
        chosen = stage(found.select("__id", "label", "r", so_far.alias("bytes")).where(F.col("bytes") <= SAMPLE_BYTES).drop("bytes"), "training_ids")
        sample = (found.join(F.broadcast(chosen.select("__id")), "__id").select("r", "label", "text").mapInArrow(words, "r int, label int, ids binary").toArrow()
                  .sort_by([("r", "ascending"), ("label", "ascending")]))
        y, learn = sample.column("label").to_numpy(), sample.column("r").to_numpy() % 5 > 0
        if not len(y) or y.min() == y.max():
            return None
        part = chosen.where("r % 5 > 0")
        if len(np.unique(y[learn])) < 2:   # too few to hold any back
            learn, part = np.ones(len(y), bool), chosen
        found = sample.column("ids").to_pylist()
        model = train([np.frombuffer(found[i], dtype=np.uint16).reshape(-1, 2) for i in np.flatnonzero(learn)], y[learn])   # 2 << BITS fits 16 bits
        del sample, found
        counts = label_counts(docs, rows, part, model, id_col, text_col)
    fresh = counts[0]
    calibrate(model, fresh if fresh.sum(axis=(0, 2)).all() else counts.sum(axis=0))
    return model


SCORE = "__toxicity"


def scored(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the calibrated score as column ``__toxicity``."""
    docs = docs.drop(SCORE)
    if model is None:
        return docs.withColumn(SCORE, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, names = docs.columns.index(text_col), docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())])

    def run(batches):
        own = shared.value
        for batch in batches:
            parts = [np.zeros(0)]
            for block in blocks(batch.column(at), BLOCK):
                words, ids, languages = encode(block)
                parts.append(own.scores(ids, words.bounds, languages))
            yield pa.record_batch([*batch.columns, pa.array(np.concatenate(parts))], names=[*names, SCORE])

    return docs.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: Model | None, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows scored below ``cut``, with their columns."""
    return scored(docs, model, text_col).where(F.col(SCORE) < cut).drop(SCORE)
