"""Quality rules on repetition from a suffix array over words (operator 2).

The words of a block of documents form one sequence in which every document has its own
letters, so suffixes match inside a document only. Prefix doubling sorts the suffixes
(only groups that are still tied are sorted again), the ranks of its levels give the
longest-common-prefix (LCP) array, and the deepest LCP interval that holds a suffix gives
the longest repeated substring that starts at that word. Spans that are not merely the
tail of the span one word earlier are the maximal repeats; their union is the covered
part of the document. A repeat whose every occurrence lies at the start of a longer repeat
("ab" in "abc abc abd abd") adds nothing to that union and is not listed by ``repeated_spans``.

Rules: a document is dropped if it has fewer than ``min_doc_words`` words, if words in
repeated 3-word windows exceed half of it (``base_failed``), if maximal repeats of at
least ``min_words`` words cover more than ``max_covered`` percent of its words, or if its
longest repeat exceeds ``max_longest`` words.

Null and empty texts have no words, zero counts and fail the base rule. Repeated rows are
judged each for itself; an empty table gives an empty result; other columns are ignored.
A document is never cut: a very long text makes a block of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .words import PLAIN_WORD, U64, Words, blocks, byte_class, mix, runs, span_hashes, split

SYMBOLS = byte_class(*[(ord(c), ord(c)) for c in "#*$%&|<>"])
_ROW = U64(0xD6E8FEB86659FD93)


def _sorted_groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys and, along it, where each element's group of equal keys begins."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.arange(len(keys))
    return order, np.maximum.accumulate(np.where(new, at, 0))


def suffix_ranks(letters: np.ndarray, left: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... letters; the last level is final.

    ``left[i]`` is the number of letters from i to the end of its document. A tied suffix
    has the rank of the first of its group; level j's ranks are equal exactly where the
    first 2**j letters are.
    """
    n = len(letters)
    order, begin = _sorted_groups(letters)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = begin
    levels, step = [rank], 1
    size = np.bincount(begin, minlength=n)
    tied = np.flatnonzero(size[rank] > 1)
    while len(tied):
        further = np.zeros(len(tied), dtype=np.int64)
        inside = left[tied] > step
        further[inside] = rank[tied[inside] + step] + 1
        order, begin = _sorted_groups((rank[tied] << 32) | further)
        moved = tied[order]
        old = rank[moved]
        head = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), np.arange(len(old)), 0))
        rank = rank.copy()
        rank[moved] = old + begin - head
        levels.append(rank)
        size = np.bincount(begin, minlength=len(tied))
        tied = moved[size[begin] > 1]
        step *= 2
    return levels


def longest_repeats(words: Words) -> np.ndarray:
    """For each word, the length of the longest substring from it that occurs again in its row."""
    n = len(words.hashes)
    longest = np.zeros(n, dtype=np.int64)
    if not n:
        return longest
    rows = words.rows
    left = np.repeat(words.bounds[1:], words.counts) - np.arange(n)
    levels = suffix_ranks(mix(words.hashes + rows.astype(U64) * _ROW), left)
    array = np.empty(n, dtype=np.int64)
    array[levels[-1]] = np.arange(n)
    pair = np.flatnonzero(levels[0][array[1:]] == levels[0][array[:-1]])
    a, b = array[pair], array[pair + 1]
    shared = np.zeros(len(pair), dtype=np.int64)
    for j in range(len(levels) - 1, -1, -1):
        inside = (shared < left[a]) & (shared < left[b])
        same = inside.copy()
        same[inside] = levels[j][(a + shared)[inside]] == levels[j][(b + shared)[inside]]
        shared += same.astype(np.int64) << j
    lcp = np.zeros(n + 1, dtype=np.int64)
    lcp[pair + 1] = shared
    longest[array] = np.maximum(lcp[:-1], lcp[1:])
    return longest


def maximal_spans(longest: np.ndarray, words: Words, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal repeats of at least ``least`` words."""
    tail = np.zeros(len(longest), dtype=bool)
    tail[1:] = longest[1:] == longest[:-1] - 1
    tail[words.bounds[:-1][words.counts > 0]] = False
    starts = np.flatnonzero((longest >= least) & ~tail)
    return starts, longest[starts]


def covered(longest: np.ndarray, words: Words, least: int) -> np.ndarray:
    """Per row, the words in the union of its repeats of at least ``least`` words."""
    starts, lengths = maximal_spans(longest, words, least)
    edge = np.zeros(len(longest) + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    total = np.zeros(len(longest) + 1, dtype=np.int64)
    np.cumsum(np.cumsum(edge[:-1]) > 0, out=total[1:])
    return np.diff(total[words.bounds])


def _row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(np.flatnonzero(flags), offsets))


def _duplicate_lines(block, words: Words) -> np.ndarray:
    starts, ends, bounds = runs(block.data != 0x0A, block.offsets)
    full = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    row = np.repeat(np.arange(block.n), np.diff(bounds))[full]
    keys = mix(span_hashes(block.data, starts[full], ends[full]) + row.astype(U64) * _ROW)
    _, first = np.unique(keys, return_index=True)
    return np.bincount(row, minlength=block.n) - np.bincount(row[first], minlength=block.n)


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat"]


def measure(block, min_words: int) -> dict[str, np.ndarray]:
    words = split(block, PLAIN_WORD)
    longest = longest_repeats(words)
    most = np.zeros(block.n, dtype=np.int64)
    full = words.counts > 0
    if full.any():
        most[full] = np.maximum.reduceat(longest, words.bounds[:-1][full])
    return {"n_words": words.counts,
            "word_chars": _row_sums(PLAIN_WORD[block.data] & ((block.data & 0xC0) != 0x80), block.offsets),
            "n_symbols": _row_sums(SYMBOLS[block.data], block.offsets),
            "n_dup_lines": _duplicate_lines(block, words),
            "n_repeat_words": covered(longest, words, 3),
            "n_covered_words": covered(longest, words, min_words),
            "longest_repeat": most}


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 8,
                     max_covered: int = 30, max_longest: int = 60, min_doc_words: int = 50) -> DataFrame:
    """One row per document: its id, the measures, ``base_failed`` and ``kept``."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)]
                          + [T.StructField(c, T.LongType()) for c in MEASURES]
                          + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1), 2 << 20):
                got = measure(block, min_words)
                failed = (got["n_words"] < min_doc_words) | (100 * got["n_repeat_words"] > 50 * got["n_words"])
                kept = (~failed & (100 * got["n_covered_words"] <= max_covered * got["n_words"])
                        & (got["longest_repeat"] <= max_longest))
                yield pa.record_batch([batch.column(0).slice(block.lo, block.n)]
                                      + [pa.array(got[c].astype(np.int64)) for c in MEASURES] + [pa.array(failed), pa.array(kept)],
                                      names=[id_col, *MEASURES, "base_failed", "kept"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 8) -> DataFrame:
    """One row per maximal repeat: document id, first word, number of words, and the text."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("first_word", T.LongType()),
                           T.StructField("n_words", T.LongType()), T.StructField("passage", T.StringType())])

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1), 2 << 20):
                words = split(block, PLAIN_WORD)
                starts, lengths = maximal_spans(longest_repeats(words), words, min_words)
                row = words.rows[starts]
                passages = [block.data[a:b].tobytes().decode()
                            for a, b in zip(words.starts[starts], words.ends[starts + lengths - 1])]
                yield pa.record_batch([batch.column(0).slice(block.lo, block.n).take(pa.array(row)),
                                       pa.array(starts - words.bounds[row]), pa.array(lengths),
                                       pa.array(passages, pa.string())],
                                      names=[id_col, "first_word", "n_words", "passage"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
