"""Language identification of mixed text: script ranges, word scores, Viterbi (operator 10).

A word's script (by code point ranges) narrows its candidate languages to those that were
seen to write in it; within these, hashed character n-grams of the word's letters give a
log-likelihood per language. Viterbi over a document's words with a penalty for every
switch labels spans; the document's language is the one whose spans hold most letters,
and the score is that share.

The model is fitted from at most ``SAMPLE_DOCS`` labelled documents per language (those
with the smallest hashes; a documented bound) whose whole texts are counted where they lie,
everything else runs over all rows and whole texts. An id that occurs repeatedly is learned from
once (its smallest text), a row without id not at all. A null text, or one without a letter, is ``und`` with score 0, as is every
text when nothing could be learned (no labelled rows). Ties go to the language that sorts
first. Repeated rows are judged each for itself; empty tables work; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import PLAIN_WORD, U64, blocks, mix, split

SAMPLE_DOCS = 1500
BITS = 17
ORDERS = (1, 2, 3)
SWITCH = 12.0         # log-likelihood a switch of language costs
OUTSIDE = -200.0      # score of a language that does not write in the word's script
SCRIPT_SHARE = 0.01   # a language writes in a script with at least this share of its letters
UNKNOWN = "und"

# First code points of script ranges (Unicode blocks), each up to the next one.
SCRIPTS = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"), (0x0E00, "thai"),
           (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
           (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
           (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
           (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x30000, "other")]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT_FROM = np.array([at for at, _ in SCRIPTS])
_SCRIPT_ID = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])
_letter = np.zeros(0x110000, dtype=np.uint8)   # 0 not looked up, 1 letter, 2 other


def is_letter(points: np.ndarray) -> np.ndarray:
    kind = _letter[points]
    if (kind == 0).any():
        for p in np.unique(points[kind == 0]).tolist():
            _letter[p] = 1 if unicodedata.category(chr(p)).startswith("L") else 2
        kind = _letter[points]
    return kind == 1


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of many words: letter counts by script [word, script]; n-gram buckets and their words."""
    points = np.frombuffer("".join(f" {t} " for t in texts).lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    gap = points == 0x20
    word = (np.cumsum(gap) - 1) // 2
    keep = gap | is_letter(points)
    points, word, gap = points[keep], word[keep], gap[keep]
    scripts = np.zeros((len(texts), len(SCRIPT_NAMES)), dtype=np.int64)
    kind = _SCRIPT_ID[np.searchsorted(_SCRIPT_FROM, points[~gap], side="right") - 1]
    np.add.at(scripts, (word[~gap], kind), 1)
    buckets, owners = [], []
    for order in ORDERS:
        if len(points) < order:
            continue
        n = len(points) - order + 1
        key = np.full(n, order, dtype=U64)
        for j in range(order):
            key = key * U64(0x9E3779B97F4A7C15) + points[j:j + n]
        inside = (word[:n] == word[order - 1:]) & ~gap[(order - 1) // 2:][:n]
        buckets.append((mix(key[inside]) >> U64(64 - BITS)).astype(np.int64))
        owners.append(word[:n][inside])
    return scripts, np.concatenate(buckets or [np.zeros(0, np.int64)]), np.concatenate(owners or [np.zeros(0, np.int64)])


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray     # [bucket, language] log-likelihood ratios
    writes: np.ndarray    # [script, language] candidate languages of each script

    def word_scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """[word, language] scores and letters per word."""
        scripts, buckets, owners = _features(texts)
        n, letters = len(texts), scripts.sum(axis=1)
        scores = np.stack([np.bincount(owners, weights=self.table[buckets, c], minlength=n) for c in range(len(self.languages))], axis=1)
        narrowed = self.writes[scripts.argmax(axis=1)]
        narrowed = narrowed | ~narrowed.any(axis=1, keepdims=True) | (letters == 0)[:, None]
        return np.where(narrowed, scores, OUTSIDE).astype(np.float32), letters


def training_rows(labelled: DataFrame, text_col: str, lang_col: str, id_col: str) -> DataFrame:
    """One text of each of at most ``SAMPLE_DOCS`` ids of each language, by hash order (columns lang, text).
    Ids are ranked, not texts."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("__id"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("__id").alias("n"))
    hashed = rows.select("lang", "__id", F.pmod(F.xxhash64("__id"), F.lit(1 << 20)).alias("h"))
    near = hashed.join(F.broadcast(counts), "lang").where(F.col("h") * F.col("n") <= F.lit(2 * SAMPLE_DOCS * (1 << 20)))  # spares the ranking most rows
    ranked = near.select("lang", "__id", "h").distinct().withColumn(
        "r", F.row_number().over(Window.partitionBy("lang").orderBy("h", F.xxhash64("__id"), "__id")))
    chosen = ranked.where(F.col("r") <= SAMPLE_DOCS).select("lang", "__id")   # at most SAMPLE_DOCS rows a language
    return rows.join(F.broadcast(chosen), ["lang", "__id"]).groupBy("lang", "__id").agg(F.min("text").alias("text")).select("lang", "text")


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """Learn from labelled rows: n-gram counts of a language, counted by every task for its own rows and summed."""
    def count(batches):
        grams, scripts = {}, {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for block in blocks(batch.column(1)):
                words = split(block, PLAIN_WORD)
                raw = block.data.tobytes()
                texts = [raw[a:b].decode() for a, b in zip(words.starts.tolist(), words.ends.tolist())]
                if not texts:
                    continue
                own = langs[block.lo:block.lo + block.n]
                known = sorted(set(own))
                owner = np.array([known.index(c) for c in own])[words.rows]   # language of each word
                by_script, buckets, words_of = _features(texts)
                for i, lang in enumerate(known):
                    grams[lang] = grams.get(lang, 0) + np.bincount(buckets[owner[words_of] == i], minlength=1 << BITS)
                    scripts[lang] = scripts.get(lang, 0) + by_script[owner == i].sum(axis=0)
        for lang in grams:
            for kind, counts in (("gram", grams[lang]), ("script", scripts[lang])):
                at = np.flatnonzero(counts)
                yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array([kind] * len(at), pa.string()),
                                       pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["lang", "kind", "at", "n"])

    counted = (training_rows(labelled, text_col, lang_col, id_col).mapInArrow(count, "lang string, kind string, at bigint, n bigint")
               .groupBy("lang", "kind", "at").agg(F.sum("n").alias("n")).toArrow())   # at most a row a language and bucket or script
    lang, kind = np.array(counted.column("lang").to_pylist(), dtype=object), np.array(counted.column("kind").to_pylist(), dtype=object)
    at, n = counted.column("at").to_numpy(), counted.column("n").to_numpy()
    languages = sorted(set(lang[kind == "script"].tolist()))   # those with a letter
    if not languages:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))
    grams, scripts = np.zeros((1 << BITS, len(languages))), np.zeros((len(SCRIPT_NAMES), len(languages)), dtype=np.int64)
    for c, name in enumerate(languages):
        grams[at[(lang == name) & (kind == "gram")], c] = n[(lang == name) & (kind == "gram")]
        scripts[at[(lang == name) & (kind == "script")], c] = n[(lang == name) & (kind == "script")]
    logs = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * len(grams)))
    return Model(languages, (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32),
                 scripts >= SCRIPT_SHARE * scripts.sum(axis=0))


def viterbi(scores: np.ndarray, bounds: np.ndarray, switch: float) -> np.ndarray:
    """The best label of every word: sum of scores less ``switch`` for every change of label.

    Rows advance together, longest first, so each step works on the rows still going.
    """
    counts = np.diff(bounds)
    order = np.argsort(-counts, kind="stable")
    starts, lengths = bounds[:-1][order], counts[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")   # rows longer than t
    label = np.zeros(len(scores), dtype=np.int64)
    stay = np.ones(scores.shape, dtype=bool)
    best = np.zeros(len(scores), dtype=np.int64)                        # best label at the word
    total = None
    for t in range(steps):
        k = int(active[t])
        at = starts[:k] + t
        if total is None:
            total = scores[at].astype(np.float64)
        else:
            total = total[:k]
            top = total[np.arange(k), best[at - 1]][:, None] - switch
            stay[at] = total >= top
            total = np.maximum(total, top) + scores[at]
        best[at] = total.argmax(axis=1)
    current = np.zeros(len(starts), dtype=np.int64)
    for t in range(steps - 1, -1, -1):
        k = int(active[t])
        ended = int(active[t + 1]) if t + 1 < steps else 0
        at = starts[:k] + t
        current[ended:k] = best[at[ended:]]
        label[at] = current[:k]
        if t:
            current[:k] = np.where(stay[at, current[:k]], current[:k], best[at - 1])
    return label


def label_block(block, model: Model, switch: float):
    """Words of a block, the label of each and its letters."""
    words = split(block, PLAIN_WORD)
    _, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
    raw = block.data
    texts = [raw[a:b].tobytes().decode() for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist())]
    if not texts or not model.languages:
        letters = _features(texts)[0].sum(axis=1) if texts else np.zeros(0, np.int64)
        return words, np.zeros(len(words.hashes), np.int64), letters[inverse]
    scores, letters = model.word_scores(texts)
    return words, viterbi(scores[inverse], words.bounds, switch), letters[inverse]


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """Per document: id, ``lang_pred``, ``score``, and ``n_spans`` (spans of one language)."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("n_spans", T.LongType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        size = max(len(own.languages), 1)
        names = np.array(own.languages or [UNKNOWN], dtype=object)
        for batch in batches:
            for block in blocks(batch.column(1)):
                words, label, letters = label_block(block, own, switch)
                row = words.rows
                held = np.bincount(row * size + label, weights=letters, minlength=block.n * size).reshape(block.n, size)
                total = held.sum(axis=1)
                known = (total > 0) & bool(own.languages)
                pred = held.argmax(axis=1)
                score = np.where(known, held[np.arange(block.n), pred] / np.maximum(total, 1), 0.0)
                new = np.ones(len(label), dtype=bool)
                new[1:] = (label[1:] != label[:-1]) | (row[1:] != row[:-1])
                spans = np.bincount(row[new], minlength=block.n) * known
                yield pa.record_batch([batch.column(0).slice(block.lo, block.n), pa.array(np.where(known, names[pred], UNKNOWN), pa.string()),
                                       pa.array(score), pa.array(spans.astype(np.int64))],
                                      names=[id_col, "lang_pred", "score", "n_spans"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def language_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """One row per span: document id, first word, number of words, language, text."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("first_word", T.LongType()),
                           T.StructField("n_words", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("span", T.StringType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        names = np.array(own.languages or [UNKNOWN], dtype=object)
        for batch in batches:
            for block in blocks(batch.column(1)):
                words, label, _ = label_block(block, own, switch)
                row = words.rows
                first = np.flatnonzero(np.append(True, (label[1:] != label[:-1]) | (row[1:] != row[:-1]))[:len(label)])
                size = np.diff(np.append(first, len(label)))
                text = [block.data[a:b].tobytes().decode() for a, b in zip(words.starts[first], words.ends[first + size - 1])]
                yield pa.record_batch([batch.column(0).slice(block.lo, block.n).take(pa.array(row[first])),
                                       pa.array(first - words.bounds[row[first]]), pa.array(size),
                                       pa.array(names[label[first]], pa.string()), pa.array(text, pa.string())],
                                      names=[id_col, "first_word", "n_words", "lang", "span"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
