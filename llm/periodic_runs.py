"""Periodic runs of words, by online dyadic square catching.

Words are appended one after another. A completed aligned block of 2^k words has a catcher, which
waits for the block to come again q words later, 2^(k+1)-1 <= q <= 2^(k+2)-2. A square of
half-length q in that range holds an aligned block of 2^k words in its first half, so one of the
catchers sees it. Of each level, an appended word completes one suffix of 2^k words and meets just
two live catchers: two hash comparisons a level and word. Catches of neighbouring blocks at one
distance are one square stretch and merge; what is left is extended by fewer than 2^k words to
either side, by comparing suffixes and prefixes of halving length.

The comparisons of a level depend on nothing but the words, so a task makes them for all words of
its documents at once, in order of the levels.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import ship_code
from llm.textcodes import mix, slices, span_codes, words

MIN_EXPONENT = 4
MIN_WORDS = 6

_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _joined(half: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of ``2 * size`` words from those of ``size`` (0 where there is none)."""
    out = np.zeros_like(half)
    if len(half) > size:
        out[:-size] = mix(half[:-size] * _LEFT + half[size:] * _RIGHT)
    return out


def find_runs(codes: np.ndarray, bounds: np.ndarray, min_exponent: int = MIN_EXPONENT,
              min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word, length and smallest period of all maximal runs of at least
    ``min_words`` words and ``min_exponent`` (2 or more) periods, by document, start and period.

    ``codes`` are the word codes of documents laid end to end, document d from ``bounds[d]`` to
    ``bounds[d + 1]``; runs never cross documents.
    """
    if min_exponent < 2:
        raise ValueError("a run holds a square: min_exponent is 2 at least")
    count_of = np.diff(bounds)
    doc = np.repeat(np.arange(len(count_of)), count_of)
    first, count = bounds[:-1][doc], count_of[doc]
    pos = np.arange(len(codes)) - first
    windows: list[np.ndarray] = []
    parts = []
    size = 1
    while len(codes) and min_exponent * (2 * size - 1) <= count_of.max():
        windows.append(_joined(windows[-1], size // 2) if windows else codes)
        low, w = 2 * size - 1, windows[-1]
        new = np.flatnonzero((count >= min_exponent * low) & (pos >= low) & (pos + size <= count))
        newest = (pos[new] - low) // size * size  # first word of the youngest catcher old enough
        caught = []
        for start in (newest, newest - size):
            q = pos[new] - start
            at = np.maximum(first[new] + start, 0)
            hit = (start >= 0) & (q * min_exponent <= count[new]) & (w[at] == w[new])
            caught.append(np.stack([doc[new[hit]], q[hit], at[hit]]))
        d, q, at = np.concatenate(caught, axis=1)
        order = np.lexsort((at, q, d))
        d, q, at = d[order], q[order], at[order]
        head = np.ones(len(d), dtype=bool)  # blocks that follow one another at one distance merge
        head[1:] = (d[1:] != d[:-1]) | (q[1:] != q[:-1]) | (at[1:] != at[:-1] + size)
        tail = np.append(head[1:], True) if len(d) else head
        d, q, lo, hi = d[head], q[head], at[head], at[tail] + size
        for level in range(len(windows) - 2, -1, -1):
            step, v = 1 << level, windows[level]
            can = np.flatnonzero(lo - step >= bounds[d])
            can = can[v[lo[can] - step] == v[lo[can] - step + q[can]]]
            lo[can] -= step
            can = np.flatnonzero(hi + q + step <= bounds[d + 1])
            can = can[v[hi[can]] == v[hi[can] + q[can]]]
            hi[can] += step
        length = hi + q - lo
        long = length >= np.maximum(min_words, min_exponent * q)
        parts.append(np.stack([d[long], lo[long] - bounds[d[long]], length[long], q[long]]))
        size *= 2
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    d, start, length, q = np.concatenate(parts, axis=1)
    order = np.lexsort((q, length, start, d))
    d, start, length, q = d[order], start[order], length[order], q[order]
    # a stretch has its multiples as periods, too; the least one comes first
    least = np.ones(len(d), dtype=bool)
    least[1:] = (d[1:] != d[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    d, start, length, q = d[least], start[least], length[least], q[least]
    order = np.lexsort((q, start, d))
    return d[order], start[order], length[order], q[order]


def repeats(n: int, d: np.ndarray, start: np.ndarray, length: np.ndarray, q: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Marks of the words that a run holds after its first period, of ``n`` words."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, bounds[d] + start + q, 1)
    np.add.at(steps, bounds[d] + start + length, -1)
    return np.cumsum(steps[:-1]) > 0


RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
_RUNS_ARROW = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def periodic_runs(docs: DataFrame, min_exponent: int = MIN_EXPONENT, min_words: int = MIN_WORDS) -> DataFrame:
    """The input's rows and columns with ``n_words``, ``runs`` (an array of start, length and
    smallest period in words, by start, then period) and ``collapsed``, the words that no run
    holds after its first period, joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+``. Runs may overlap; each is reported. Each row is worked on by
    itself: repeated rows and equal texts give equal results, whatever their other columns. A null
    text has no words, no runs and a null ``collapsed``; an empty or blank one none and "". A text is
    read whole; a task holds some 8 bytes for each of its words and level, so its longest text
    sets the memory (levels grow with the logarithm of its words). Words and windows are compared
    by 64-bit hashes. Input columns of the names of the new ones are replaced; an empty table
    gives an empty one.
    """
    ship_code(docs.sparkSession)
    names = ["n_words", "runs", "collapsed"]
    docs = docs.drop(*names)
    text_at = docs.columns.index("text")
    schema = T.StructType(docs.schema.fields + [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS),
                                               T.StructField("collapsed", T.StringType())])

    def run(batches):
        for batch in batches:
            texts = batch.column(text_at)
            for row, end, data, offsets in slices(texts):
                begins, ends, doc = words(data, offsets)
                bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=end - row))])
                d, start, length, q = find_runs(span_codes(data, begins, ends), bounds, min_exponent, min_words)
                again = repeats(len(doc), d, start, length, q, bounds)
                cut = np.bincount(doc[again], minlength=end - row) > 0
                raw = data.tobytes()
                collapsed = []
                for i in range(end - row):
                    if not texts[row + i].is_valid:
                        collapsed.append(None)
                        continue
                    parts = raw[offsets[i]:offsets[i + 1]].split()  # bytes split on the same white space
                    if cut[i]:
                        parts = compress(parts, ~again[bounds[i]:bounds[i + 1]])
                    collapsed.append(b" ".join(parts))
                rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, q)],
                                                  names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(d, np.arange(end - row + 1)), pa.int32()), rows)
                yield pa.RecordBatch.from_arrays(
                    [c.slice(row, end - row) for c in batch.columns]
                    + [pa.array(np.diff(bounds), pa.int64()), lists.cast(_RUNS_ARROW), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=schema.fieldNames())

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, schema)
