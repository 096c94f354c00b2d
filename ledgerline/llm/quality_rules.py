"""Quality rules: fixed limits, and an isolation forest on the statistics that the rules read.

One pass over the texts counts words, symbols, repeated lines and repeated three-word
windows. A forest of random splits is grown on a bounded sample of good labelled rows; a
document that few splits set apart from them has a short path and a high anomaly score.
The score above which documents go is calibrated on labelled rows. Only the trees come from
a sample (``SAMPLE_ROWS``); every document is scored, and the threshold is taken over all
labelled rows.

Defined cases: a null or empty text has no words and fails the base rule; a null doc_id is
kept as null; repeated rows are judged one by one and come out alike; without labelled rows
of both kinds the method keeps everything that the base rule keeps; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import materialise, python_batches, text_bytes

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

TREES = 300
TREE_ROWS = 256
DEPTH = 12
#: good labelled rows that the trees draw their samples from
SAMPLE_ROWS = 4_096
#: bins of the score, from 0 to 1, when the threshold is calibrated
SCORE_BINS = 2_000
#: the share of good labelled documents that may be lost
MAX_GOOD_LOST = 0.0001

STATS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    *[T.StructField(c, T.LongType(), False)
      for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")],
])


def count_repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    inside = np.zeros(len(words), dtype=bool)
    starts = np.fromiter((times[w] > 1 for w in windows), dtype=bool, count=len(windows))
    for shift in range(3):
        inside[shift:shift + len(starts)] |= starts
    return int(inside.sum())


def text_stats(text: bytes) -> tuple[int, int, int, int, int, int]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        count_repeat_words(words),
        len(lines),
    )


def _stats_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_stats(t) for t in text_bytes(batch.column("text"))]
        columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))]
        if rows:
            yield pa.RecordBatch.from_arrays(columns, names=STATS.names)


def document_stats(docs: DataFrame) -> DataFrame:
    """One row of counts per document."""
    python_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _stats_batches, STATS)


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


#: upper ends of the box that splits are drawn in; larger values count as these
BOX = np.array([16.0, 1.0, 1.0, 1.0])
FEATURES = ("chars_per_word", "symbols_per_word", "dup_line_share", "repeat_share")


def features() -> list[F.Column]:
    """What the forest splits on: shares, so that a long document isn't odd for its length."""
    def per(a: str, b: str) -> F.Column:
        return F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1))

    return [
        per("word_chars", "n_words").alias("chars_per_word"),
        per("n_symbols", "n_words").alias("symbols_per_word"),
        per("n_dup_lines", "n_lines").alias("dup_line_share"),
        per("n_repeat_words", "n_words").alias("repeat_share"),
    ]


def expected_path(n: np.ndarray | int) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=np.float64)
    far = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, far, np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """Random splits over the box of all shares, held as arrays: split column and value, children, path length.

    The splits are drawn in the whole box rather than between the sample's extremes. So a
    value that no sampled row has, such as symbols after every word, is cut off early.
    """

    def __init__(self, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, depth: int = DEPTH, seed: int = 7):
        draw = np.random.default_rng(seed)
        rows = np.clip(rows, 0.0, BOX)
        self.size, self.depth = min(tree_rows, len(rows)), depth
        self.trees = [self._grow(rows[draw.choice(len(rows), self.size, replace=False)], draw, depth) for _ in range(trees)]

    @staticmethod
    def _grow(rows: np.ndarray, draw: np.random.Generator, limit: int) -> tuple[np.ndarray, ...]:
        nodes: list[list] = []

        def node(part: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([-1, 0.0, at, at, depth + float(expected_path(len(part)))])
            if depth < limit and len(part):
                column = int(draw.integers(len(low)))
                value = float(draw.uniform(low[column], high[column]))
                below, middle = part[:, column] < value, np.where(np.arange(len(low)) == column, value, 0.0)
                upto = np.where(np.arange(len(low)) == column, middle, high)
                start = np.where(np.arange(len(low)) == column, middle, low)
                nodes[at][:2] = column, value
                nodes[at][2] = node(part[below], low, upto, depth + 1)
                nodes[at][3] = node(part[~below], start, high, depth + 1)
            return at

        node(rows, np.zeros(len(BOX)), BOX.copy(), 0)
        return tuple(np.array(x) for x in zip(*nodes, strict=True))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 is odd, about one half or less is ordinary."""
        rows = np.clip(rows, 0.0, BOX)
        total, each = np.zeros(len(rows)), np.arange(len(rows))
        for column, value, left, right, path in self.trees:
            at = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth):
                below = rows[each, np.maximum(column[at], 0)] < value[at]
                at = np.where(column[at] >= 0, np.where(below, left[at], right[at]), at)
            total += path[at]
        return np.exp2(-(total / len(self.trees)) / max(float(expected_path(self.size)), 1.0))


def known_quality(labels: DataFrame) -> DataFrame:
    """One label per document; a document labelled both ways counts as bad."""
    return labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.min(F.col("quality").cast("int")).alias("quality"))


def fit_forest(stats: DataFrame, labels: DataFrame) -> IsolationForest | None:
    """Trees over at most ``SAMPLE_ROWS`` good labelled documents, drawn by a hash so that reruns agree."""
    good = stats.filter(~base_failed()).join(known_quality(labels).filter("quality = 1").select("doc_id"), "doc_id", "left_semi")
    sample = good.select("doc_id", *features()).orderBy(
        F.xxhash64("doc_id", F.lit("forest")), *FEATURES).limit(SAMPLE_ROWS).collect()
    if not sample:
        return None
    return IsolationForest(np.array([[r[c] for c in FEATURES] for r in sample], dtype=np.float64))


def with_score(stats: DataFrame, forest: IsolationForest) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in FEATURES])
            kept = [batch.column(c) for c in STATS.names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(forest.score(rows))], names=[*STATS.names, "anomaly"])

    return stats.select(*STATS.names, *features()).mapInArrow(
        score, T.StructType([*STATS.fields, T.StructField("anomaly", T.DoubleType(), False)]))


def calibrate(scored: DataFrame, labels: DataFrame, max_good_lost: float = MAX_GOOD_LOST) -> float | None:
    """The lowest score above which at most ``max_good_lost`` of the good labelled documents lie.

    Among the thresholds that keep to this, the one in the middle of the gap towards the next
    worse score is taken. All labelled rows count, as a histogram of fixed size.
    """
    bins = scored.filter(~base_failed()).join(known_quality(labels), "doc_id").groupBy(
        F.floor(F.col("anomaly") * SCORE_BINS).cast("int").alias("bin")).agg(
        F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("bad")).collect()
    good, bad = np.zeros(SCORE_BINS + 2), np.zeros(SCORE_BINS + 2)
    for r in bins:
        good[r["bin"]], bad[r["bin"]] = r["good"], r["bad"]
    if not good.sum() or not bad.sum():
        return None
    lost = good[::-1].cumsum()[::-1]  # good documents in this bin or above
    first = int(np.flatnonzero(lost <= max_good_lost * good.sum())[0])
    above = np.flatnonzero(bad[first:])
    return (first + (int(above[0]) / 2 if len(above) else 0)) / SCORE_BINS


def fit(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, IsolationForest | None, float | None]:
    """The counts of all documents (written once), the forest and the calibrated threshold."""
    stats = materialise(document_stats(docs), "quality_stats")
    forest = fit_forest(stats, labels)
    return stats, forest, None if forest is None else calibrate(with_score(stats, forest), labels)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: the counts, ``base_failed``, the anomaly score and ``kept``."""
    stats, forest, threshold = fit(docs, labels)
    scored = with_score(stats, forest) if forest else stats.withColumn("anomaly", F.lit(0.0))
    odd = F.lit(False) if threshold is None else F.col("anomaly") >= F.lit(float(threshold))
    return scored.select(*STATS.names, base_failed().alias("base_failed"), "anomaly",
                         (~base_failed() & ~odd).alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules and the forest keep, in its columns; each row is judged by its own text."""
    _, forest, threshold = fit(docs, labels)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([text_stats(t) for t in text_bytes(batch.column(at))], dtype=np.float64).reshape(-1, 6)
            words, chars, symbols, dup_lines, repeats, lines = rows.T
            good = ~((words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words))
            if threshold is not None:
                shares = [a / np.maximum(b, 1) for a, b in ((chars, words), (symbols, words), (dup_lines, lines), (repeats, words))]
                good &= forest.score(np.column_stack(shares)) < threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
