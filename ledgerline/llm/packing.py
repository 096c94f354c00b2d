"""Packing by power-of-two decomposition.

A document of L tokens (its end mark included) is cut into blocks of ``SEQUENCE`` tokens and
then into the powers of two that add up to the rest, largest first. Each piece is a training
sequence of its own, whose length is a power of two: no sequence crosses documents and none
is padded. Pieces of equal length form a bucket, from which batches of one shape are drawn;
the highest bits of ``sequence_id`` are the bucket (the logarithm of the length).

Tokens are those of the tokenizer file. Plain Latin text is encoded with the same vocabulary
by a faster library that cuts and merges alike; texts with other characters, with special
strings or with runs of thousands of characters go to the tokenizer itself.

The sequence number is made of the bucket, the task and a count within the task, so numbering
needs no shuffle and no second pass. A repeated run over the same files numbers alike.

Defined cases: a null or empty text is the end mark alone, one piece of length 1; a null
doc_id is kept; repeated rows are packed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import python_batches
from ledgerline.llm.token_counts import tokenizer

SEQUENCE = 2048
END = 1
#: sequence_id: bucket above, then 24 bits of task and 32 bits of number
BUCKET_SHIFT, TASK_SHIFT = 56, 32

#: anything but plain Latin text, or a special string
NOT_PLAIN = re.compile("[^\t\n\r -~¡-ɏ]|<\\|")
LONG_RUN = 1000
LONG_SPACE = re.compile(rf"\s{{{LONG_RUN}}}")


@functools.cache
def fast_encoder(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("pack", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Token ids of one text as an array."""

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None):
        self.exact = tokenizer(tokenizer_path)
        self.fast = fast_encoder(ranks_path, pattern) if ranks_path else None

    def ids(self, text: str) -> np.ndarray:
        if self.fast and not NOT_PLAIN.search(text) and not (
                len(text) >= LONG_RUN and (max(map(len, text.split()), default=0) >= LONG_RUN or LONG_SPACE.search(text))):
            return np.asarray(self.fast.encode_to_numpy(text), dtype="<u4")
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")


def pieces_of(length: int, sequence: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole sequences, then falling powers of two."""
    whole = length // sequence
    out = [(i * sequence, sequence) for i in range(whole)]
    at, rest = whole * sequence, length % sequence
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None,
         with_ids: bool = False) -> DataFrame:
    """One row per piece; with ``with_ids`` also its token ids."""
    python_batches(docs.sparkSession)
    schema = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
              + ", ids array<int>" * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, number = Encoder(tokenizer_path, ranks_path, pattern), TaskContext.get().partitionId(), 0
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(encoder.ids(text.as_py()), np.uint32(END)).astype("<u4")
                for start, length in pieces_of(len(ids)):
                    part = ids[start:start + length]
                    sequence_id = ((length.bit_length() - 1) << BUCKET_SHIFT) + (task << TASK_SHIFT) + number
                    number += 1
                    rows.append((doc_id, start, length, zlib.crc32(part.tobytes()), len(ids), sequence_id, 0)
                                + ((part.astype("<i4"),) if with_ids else ()))
            if rows:
                columns = list(zip(*rows, strict=True))
                arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
                if with_ids:
                    sizes = np.cumsum([0, *columns[2]])
                    arrays.append(pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(columns[7]))))
                yield pa.RecordBatch.from_arrays(arrays, names=[
                    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"][:len(arrays)])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, schema)


def buckets(pieces: DataFrame) -> DataFrame:
    """Sequences and tokens of each bucket of equal lengths."""
    return pieces.groupBy("length").agg(F.count_distinct("sequence_id").alias("sequences"), F.sum("length").alias("tokens"))
