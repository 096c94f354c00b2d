"""Periodic runs of words, found with an enhanced suffix array.

A run is a stretch of words with smallest period q that no neighbouring word extends. Its
last square of period q, at i, can't be moved to the right, so the suffixes i and i + q agree
on exactly q words: both lie in one LCP interval of depth q, in different children of it. For
every LCP interval the suffixes of all children but the largest are tested: are i + depth or
i - depth in the same interval, by the inverse suffix array, and in another child? Each such
branching square is then rotated to the left as far as it goes, and squares that end together
and lie in one another are merged into the run of the least period.

The array is built for blocks of whole documents at once: suffixes sort by document first, so
documents don't meet. Sorting is by prefix doubling over what is still tied, the common
prefixes come from the irreducible ones (those that can't be derived from the position
before), and the intervals from previous and next smaller values; all are passes over numpy
arrays, and no tree nodes are made. Documents are independent: no shuffle.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text; a null
doc_id is kept; repeated rows are worked on one by one; equal words count as equal whatever
their number; a text longer than a block makes a block of its own, whose memory grows in
proportion to its words; an empty table gives an empty result. Columns other than doc_id and
text are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import python_batches, text_bytes

#: a run is reported from so many words and periods on
LEAST_LENGTH, LEAST_EXPONENT = 6, 4
#: documents are worked on together up to so many words, which bounds a worker's memory
BLOCK_WORDS = 1 << 17
#: cells of a temporary matrix or list
CELLS = 1 << 20

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def agreeing(codes: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many codes agree from positions ``a`` and ``b`` on, going by ``step`` (1 or -1).

    Compared in stretches that double, over the pairs that still agree. Every document ends
    with a code of its own, so a pair differs before it leaves the array.
    """
    out, left, width = np.zeros(len(a), np.int64), np.arange(len(a)), 4
    while len(left):
        same, rows = np.zeros(len(left), bool), max(1, CELLS // width)
        for k in range(0, len(left), rows):
            part = left[k:k + rows]
            steps = step * (out[part][:, None] + np.arange(width))
            differ = codes.take(a[part][:, None] + steps, mode="clip") != codes.take(b[part][:, None] + steps, mode="clip")
            same[k:k + rows] = ~differ.any(1)
            out[part] += np.where(same[k:k + rows], width, differ.argmax(1))
        left, width = left[same], min(2 * width, CELLS)
    return out


def suffix_array(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse, and the codes that the suffixes were compared by.

    ``first`` orders single positions; equal values are equal words of one document.
    """
    n = len(first)
    sa = np.argsort(first, kind="stable")
    ordered = first[sa]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    codes = rank.copy()
    tied = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
    h = 1
    while len(tied):
        at = sa[tied]
        key = rank[at] * n + rank[at + h]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        sa[tied] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        tied = tied[~(new & np.concatenate([new[1:], [True]]))]
        h *= 2
    return sa, rank, codes


def common_prefixes(codes: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """``lcp[k]``: codes in common of the suffixes at k - 1 and k; a zero is put at both ends.

    A position whose preceding code also precedes its neighbour has one less than the
    position before. Only the others are compared, which takes n log n codes in all.
    """
    n = len(sa)
    neighbour = np.zeros(n, np.int64)
    neighbour[sa[1:]] = sa[:-1]
    own = np.arange(n)
    compared = np.concatenate([[True], codes[:-1] != codes[neighbour[1:] - 1]])
    compared[sa[0]] = True
    found = np.zeros(n, np.int64)
    at = own[compared]
    at = at[at != sa[0]]
    found[at] = agreeing(codes, at, neighbour[at], 1)
    last = np.maximum.accumulate(np.where(compared, own, 0))
    lcp = (found[last] - (own - last))[sa]
    lcp[0] = 0
    return np.append(lcp, 0)


def previous_smaller(values: np.ndarray, strictly: bool) -> np.ndarray:
    """For each positive value the nearest earlier position of a smaller (or not greater) one, by jumping over known stretches."""
    found = np.arange(len(values)) - 1
    left = np.flatnonzero(values > 0)
    while len(left):
        there = values[found[left]]
        left = left[there >= values[left] if strictly else there > values[left]]
        found[left] = found[found[left]]
    return found


def branching_squares(sa: np.ndarray, rank: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end, period) of every square that can't be moved right, by end, then period."""
    n = len(sa)
    none = np.zeros(0, np.int64)
    inner = np.flatnonzero(lcp > 0)
    if not len(inner):
        return none, none
    before, before_equal = previous_smaller(lcp, True), previous_smaller(lcp, False)
    after = (n - previous_smaller(lcp[::-1], True))[::-1]
    after_equal = (n - previous_smaller(lcp[::-1], False))[::-1]
    # the children of an interval begin where its depth occurs; the first one at its left end
    leading = inner[before_equal[inner] == before[inner]]
    start = np.concatenate([inner, before[leading]])
    end = np.concatenate([after_equal[inner], leading])
    of = np.concatenate([inner, leading])
    low, high, depth = before[of], after[of], lcp[of]
    _, interval = np.unique(low * (n + 1) + high, return_inverse=True)
    size = end - start
    largest = np.zeros(interval.max() + 1, np.int64)
    np.maximum.at(largest, interval, size)
    widest = np.flatnonzero(size == largest[interval])
    spared = np.zeros(len(largest), np.int64)
    spared[interval[widest]] = widest
    tested = np.ones(len(size), bool)
    tested[spared] = False
    tested = np.flatnonzero(tested)
    found = [none]
    upto = np.cumsum(size[tested])
    for part in np.split(tested, np.searchsorted(upto, np.arange(CELLS, upto[-1], CELLS))) if len(tested) else []:
        count = size[part]
        child = np.repeat(part, count)
        i = sa[np.arange(len(child)) - np.repeat(np.cumsum(count) - count, count) + start[child]]
        for other, square in ((i + depth[child], i), (i - depth[child], i - depth[child])):
            r = rank.take(other, mode="clip")
            hit = ((other >= 0) & (other < n) & (r >= low[child]) & (r < high[child])
                   & ((r < start[child]) | (r >= end[child])))
            q = depth[child][hit]
            found.append((square[hit] + 2 * q) * (n + 1) + q)
    found = np.unique(np.concatenate(found))
    return found // (n + 1), found % (n + 1)


def runs_of(first: np.ndarray, least_length: int, least_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs over positions ordered by ``first``; each document ends with a code of its own."""
    sa, rank, codes = suffix_array(first)
    end, period = branching_squares(sa, rank, common_prefixes(codes, sa))
    found = [np.zeros((3, 0), np.int64)]
    while len(end):
        # of the squares that end together, the least period left is that of a run
        least = np.concatenate([[True], end[1:] != end[:-1]])
        e, q = end[least], period[least]
        start = e - 2 * q
        start = start - agreeing(codes, start - 1, start + q - 1, -1)
        found.append(np.stack([start, e, q]))
        # squares inside that run are powers of its period
        run = np.cumsum(least) - 1
        left = ~least & (end - 2 * period < start[run])
        end, period = end[left], period[left]
    start, end, period = np.concatenate(found, axis=1)
    kept = end - start >= np.maximum(least_length, least_exponent * period)
    return start[kept], end[kept], period[kept]


def block_runs(documents: list[list[bytes]], least_length: int, least_exponent: int) -> tuple[np.ndarray, ...]:
    """(document, start, length, period) of the runs of several documents, by document, start and period."""
    words: defaultdict[bytes, int] = defaultdict()
    words.default_factory = words.__len__
    sizes = np.array([len(d) for d in documents], np.int64)
    base = np.concatenate([[1], 1 + np.cumsum(sizes + 1)])  # position 0 stands before the first document
    first = np.zeros(base[-1], np.int64)
    for d, at in zip(documents, base, strict=False):
        first[at:at + len(d)] = np.fromiter(map(words.__getitem__, d), np.int64, len(d)) + 1
    owner = np.repeat(np.arange(1, len(documents) + 1), sizes + 1)
    first[1:] += owner * (len(words) + 1)
    start, end, period = runs_of(first, least_length, least_exponent)
    document = np.searchsorted(base, start, side="right") - 1
    order = np.lexsort((period, start, document))
    document, start, end, period = document[order], start[order], end[order], period[order]
    return document, start - base[document], end - start, period


def without(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(start):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return b" ".join(compress(words, np.cumsum(depth) == 0))


def collapse(docs: DataFrame, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """Per document: doc_id, n_words, ``runs`` by start, then period, and the text ``collapsed`` to one period of each run."""
    python_batches(docs.sparkSession)

    def worked(ids: list, documents: list[list[bytes]]) -> pa.RecordBatch:
        document, start, length, period = block_runs(documents, least_length, least_exponent)
        cut = np.searchsorted(document, np.arange(len(documents) + 1))
        texts = [without(d, start[a:b], length[a:b], period[a:b]) for d, a, b in zip(documents, cut[:-1], cut[1:], strict=True)]
        runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], names=["start", "length", "period"])
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(d) for d in documents], pa.int64()),
            pa.ListArray.from_arrays(pa.array(cut, pa.int32()), runs), pa.array(texts, pa.binary()).cast(pa.string()),
        ], names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, documents, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text")), strict=True):
                ids.append(doc_id)
                documents.append(text.split())
                held += len(documents[-1]) + 1
                if held >= BLOCK_WORDS:
                    yield worked(ids, documents)
                    ids, documents, held = [], [], 0
        if ids:
            yield worked(ids, documents)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")
