"""Token counts by a two-tier lookup on the map side.

The tokenizer never joins characters across white space, so a text's count is the sum over
its white-space separated pre-tokens. The first tier is a compact table of the corpus's
frequent pre-tokens and their lengths in tokens, broadcast to all workers; its size is
fixed (``TABLE_WORDS`` entries of at most ``WORD_CHARS`` characters). The second tier is a
cache in each worker: a pre-token missing from both is encoded once, in batches, by the
library itself. No pre-token is shuffled: to find the frequent ones, every task reads all
its texts and returns a summary of fixed size, and only these summaries are added up. The
table decides the speed, never a count.

Defined cases: a null or empty text has 0 bytes and 0 tokens; a null doc_id is kept; repeated
rows are counted one by one; special strings inside a text count as the library takes them
by default; texts with the control characters 1C to 1F, which Python and the tokenizer
separate differently, are encoded whole; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import python_batches

#: entries of the broadcast table, and of each task's summary
TABLE_WORDS = 16_384
SUMMARY_WORDS = 8_192
WORD_CHARS = 48
#: a worker's cache is emptied when it holds this many pre-tokens
CACHE_WORDS = 400_000
LIMIT = 2048

CUT_DIFFERENTLY = re.compile("[\x1c-\x1f]")
#: letters with full stops or commas behind them: the tokenizer separates the two, and lower-cases
LETTERS = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([.,]+)?")


@functools.cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_lengths(path: str, words: list[str]) -> list[int]:
    return [len(e) for e in tokenizer(path).encode_batch_fast(words, add_special_tokens=False)]


#: plain words that are encoded in one call
TOGETHER = 500


@functools.cache
def word_ends(path: str) -> np.ndarray:
    """Which tokens end a pre-token."""
    t = tokenizer(path)
    return np.array([(t.id_to_token(i) or "").endswith("</w>") for i in range(t.get_vocab_size())])


def lengths_of_plain(path: str, words: list[str], pre_tokens: list[int]) -> list[int]:
    """Token counts of words known to be one or two pre-tokens, many in a call: each pre-token ends with a token that says so."""
    out: list[int] = []
    parts = range(0, len(words), TOGETHER)
    lines = tokenizer(path).encode_batch_fast([" ".join(words[i:i + TOGETHER]) for i in parts], add_special_tokens=False)
    for i, encoded in zip(parts, lines, strict=True):
        ends, each = np.flatnonzero(word_ends(path)[encoded.ids]), np.cumsum(pre_tokens[i:i + TOGETHER])
        if len(ends) == each[-1]:
            out += np.diff(ends[each - 1], prepend=-1).tolist()
        else:
            out += token_lengths(path, words[i:i + TOGETHER])
    return out


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column("text"):
            seen.update((text.as_py() or "").split())
        if len(seen) > 16 * SUMMARY_WORDS:
            seen = Counter(dict(seen.most_common(4 * SUMMARY_WORDS)))
    found = [(w, n) for w, n in seen.most_common(SUMMARY_WORDS) if len(w) <= WORD_CHARS]
    if found:
        yield pa.RecordBatch.from_pydict({"word": [w for w, _ in found], "n": pa.array([n for _, n in found], pa.int64())})


def frequent_words(docs: DataFrame) -> list[str]:
    """At most ``TABLE_WORDS`` frequent pre-tokens of the whole corpus, from the tasks' summaries."""
    summaries = docs.select("text").mapInArrow(_summaries, "word string, n bigint")
    top = summaries.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(TABLE_WORDS)
    return [r["word"] for r in top.collect()]


class Lengths:
    """Token counts of texts from the frequent table, then this worker's cache, then the library."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.path, self.frequent, self.known = path, frequent, dict(frequent)

    def learn(self, words: Iterable[str]) -> None:
        """Encodes words and adds them to the cache."""
        plain, pre_tokens, others = [], [], []
        for word in words:
            match = LETTERS.fullmatch(word)
            if match:
                plain.append(word), pre_tokens.append(2 if match[2] else 1)
            else:
                others.append(word)
        self.known.update(zip(plain, lengths_of_plain(self.path, plain, pre_tokens), strict=True))
        self.known.update(zip(others, token_lengths(self.path, others), strict=True))

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.known) > len(self.frequent) + CACHE_WORDS:
            self.known = dict(self.frequent)
        words = [t.split() for t in texts]
        misses = list(set().union(*words) - self.known.keys())
        self.learn(misses)
        found = [sum(map(self.known.__getitem__, ws)) for ws in words]
        for word in misses:
            if len(word) > WORD_CHARS:
                del self.known[word]
        for i, text in enumerate(texts):
            if CUT_DIFFERENTLY.search(text):
                found[i] = token_lengths(self.path, [text])[0]
        return found


_workers: dict[tuple[str, int], Lengths] = {}


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every document."""
    spark = docs.sparkSession
    python_batches(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = frequent_words(rows)
    table = spark.sparkContext.broadcast(dict(zip(words, token_lengths(tokenizer_path, words), strict=True)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tokenizer_path, id(table.value))
        worker = _workers.get(key)
        if worker is None:
            _workers.clear()
            worker = _workers[key] = Lengths(tokenizer_path, table.value)
        for batch in batches:
            n = worker.counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    counted = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint")).mapInArrow(
        count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
