"""Substring dedup by De Bruijn compaction.

Windows of ``WINDOW`` (13) words are the edges of a De Bruijn graph over the corpus; its nodes
are runs of 12 words. A passage that documents share is a path of repeated edges. Where all
occurrences of a node go on alike, the path doesn't branch, so every document that has one
edge of such a path has all of it. Repeated nonbranching paths are therefore compacted into
single rows (key, document, start, length), and Spark joins over these rows, not over
windows, tell which document has a path first. A path's key digests the words at its source
coordinates, so a collision of window hashes can never remove anything.

The graph is found in two exchanges, both of hashes in ranges of the hash space, made
distinct per block of documents before they are sent; no hot passage gathers anywhere:

1. A window's least hash of 8 consecutive words is the same wherever the window occurs. A
   window whose least hash occurs in one document only is not repeated. That leaves about
   the windows that really are, for the price of a third of a hash per word.
2. The nodes of these candidate windows are sent with a digest of the words before and after
   them. A node with two different surroundings branches; each path is cut there.

The answers are one bit for each hash that a block has sent. Blocks of compressed texts are
written once as a table bucketed by block, so none of the four passes over them shuffles
text. Whole copies of an earlier document are found by a digest beforehand and take no part.

Defined cases: a null or empty text has no words; texts under 13 words have no windows and
lose nothing; a null doc_id is larger than all others and two such rows don't remove each
other's words, like rows of one doc_id; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, python_batches, scratch_copies, settled, text_bytes
from ledgerline.session import scratch_path

WINDOW = 13
NODE = WINDOW - 1
#: words whose hash stands for a window; a window has WINDOW - ANCHOR + 1 of them
ANCHOR = 8
#: text of a block before compression
BLOCK_BYTES = 4 << 20
#: words whose hashes one range of an exchange holds at most (a third of them are sent)
RANGE_WORDS = 16_000_000
CONTEXT_BYTES = 6
#: a null doc_id, above all others
LAST_ID = (1 << 63) - 1

BLOCK = "block bigint, bodies binary, sizes binary, doc_ids array<bigint>, n_words array<bigint>, digests array<binary>"
SENT = "bucket int, block bigint, n int, keys binary, contexts binary, mixed binary"
ANSWER = "bucket int, block bigint, bits binary"
PATH = "high bigint, low bigint, block bigint, nr int, doc_id bigint, first_start int, starts array<int>, windows int"
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, n_spans bigint"


# ---- blocks -------------------------------------------------------------------------------------

def _block_row(number: int, texts: list[bytes], doc_ids: list[int | None]) -> pa.RecordBatch:
    words = [t.split() for t in texts]
    row = {
        "block": pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()),
        "bodies": pa.array([zstandard.ZstdCompressor(level=1).compress(b"".join(texts))], pa.binary()),
        "sizes": pa.array([np.array([len(t) for t in texts], dtype="<i8").tobytes()], pa.binary()),
        "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
        "n_words": pa.array([[len(w) for w in words]], pa.list_(pa.int64())),
        "digests": pa.array([[xxhash.xxh3_128_digest(b" ".join(w)) for w in words]], pa.list_(pa.binary())),
    }
    return pa.RecordBatch.from_pydict(row)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, size, texts, ids = 0, 0, [], []
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text")), strict=True):
            if texts and size + len(text) > BLOCK_BYTES:
                yield _block_row(number, texts, ids)
                number, size, texts, ids = number + 1, 0, [], []
            texts.append(text), ids.append(doc_id)
            size += len(text)
    if texts:
        yield _block_row(number, texts, ids)


@dataclass
class Block:
    """The words of a block's documents one after another, with the arrays that all passes need."""

    words: list[bytes]
    lengths: np.ndarray
    hashes: np.ndarray
    #: per word: its document, and where that begins and ends
    nr: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        sizes = np.frombuffer(row["sizes"], dtype="<i8")
        body, ends = zstandard.ZstdDecompressor().decompress(row["bodies"]), np.cumsum(sizes)
        per_text = [body[e - n:e].split() for n, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
        lengths = np.array([len(w) for w in per_text], dtype=np.int64)
        words = [w for ws in per_text for w in ws]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
        stop = np.cumsum(lengths)
        return cls(words, lengths, hashes, np.repeat(np.arange(len(lengths)), lengths),
                   np.repeat(stop - lengths, lengths), np.repeat(stop, lengths))

    def runs(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each position on; past a document's end it means nothing."""
        n = len(self.hashes)
        out = np.zeros(n, dtype=np.uint64)
        for j in range(min(size, n)):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out[:n - j] += self.hashes[j:]
        return _mixed(out)

    def windows(self, left_out: np.ndarray) -> np.ndarray:
        """Where a window begins, except in the documents that are left out."""
        whole = np.arange(len(self.hashes)) + WINDOW <= self.end
        return whole & ~left_out[self.nr] if len(whole) else whole

    def anchors(self) -> np.ndarray:
        """The least hash of ANCHOR words in the window that begins at each position."""
        each = self.runs(ANCHOR)
        least = each.copy()
        for j in range(1, WINDOW - ANCHOR + 1):
            np.minimum(least[:-j], each[j:], out=least[:-j])
        return least

    def contexts(self) -> np.ndarray:
        """Digest of the words before and after the node at each position, with marks at a document's ends."""
        n = len(self.hashes)
        at = np.arange(n)
        before = np.where(at > self.begin, np.roll(self.hashes, 1), np.uint64(1))
        after = np.full(n, 2, dtype=np.uint64)
        has = at + NODE < self.end
        after[has] = self.hashes[at[has] + NODE]
        both = _mixed(_mixed(before) * np.uint64(0xD6E8FEB86659FD93) + after)
        return both & np.uint64((1 << 8 * CONTEXT_BYTES) - 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def block_table(docs: DataFrame, path: str, name: str) -> DataFrame:
    """Blocks of documents, written as a table bucketed by block."""
    spark = docs.sparkSession
    python_batches(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # each bucket's blocks in one file
    rows.mapInArrow(_blocks, BLOCK).repartition(buckets, "block").write.bucketBy(buckets, "block").option(
        "path", path).option("compression", "none").saveAsTable(name)
    return spark.table(name)


# ---- exchanges of hashes --------------------------------------------------------------------------

def _narrow(values: np.ndarray) -> bytes:
    """Unsigned numbers in as many bytes each as the largest needs; the first byte says how many."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    width = data[0]
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(n, width)
    return out.view("<u8").reshape(n)


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n).astype(bool)


def _edges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where the sorted keys of each bucket (their highest bits) begin, and the end."""
    starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, dtype=np.uint64)
    return np.r_[np.searchsorted(keys, starts), len(keys)]


def _sent(block: int, keys: np.ndarray, contexts: np.ndarray | None, mixed: np.ndarray, bits: int) -> pa.RecordBatch:
    """A block's distinct sorted keys, a row for each bucket that has some."""
    edges, rows = _edges(keys, bits), []
    for bucket in np.flatnonzero(np.diff(edges)).tolist():
        i, j = edges[bucket], edges[bucket + 1]
        steps = np.diff(keys[i:j], prepend=np.uint64((bucket << (64 - bits)) if bits else 0))
        rows.append((bucket, block, int(j - i), _narrow(steps),
                     _narrow(contexts[i:j]) if contexts is not None else None, np.packbits(mixed[i:j]).tobytes()))
    columns = list(zip(*rows, strict=True)) or [()] * 6
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      names=["bucket", "block", "n", "keys", "contexts", "mixed"])


def _answers(rows: list[dict], bits: int) -> pa.RecordBatch:
    """For each key that a block sent: does any other block have it (without contexts), or have it otherwise."""
    bucket, counts = rows[0]["bucket"], [r["n"] for r in rows]
    base = np.uint64((bucket << (64 - bits)) if bits else 0)
    keys = np.concatenate([np.cumsum(_wide(r["keys"], r["n"]), dtype=np.uint64) + base for r in rows])
    yes = np.concatenate([_bits(r["mixed"], r["n"]) for r in rows])
    order = np.argsort(keys, kind="stable")
    begin = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0])
    group = np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, len(keys)]))
    if rows[0]["contexts"] is None:
        found = np.diff(np.r_[begin, len(keys)]) > 1
    else:
        contexts = np.concatenate([_wide(r["contexts"], r["n"]) for r in rows])[order]
        found = np.minimum.reduceat(contexts, begin) != np.maximum.reduceat(contexts, begin)
    found = found | np.logical_or.reduceat(yes[order], begin)
    answer = np.empty(len(keys), dtype=bool)
    answer[order] = found[group]
    parts = np.split(answer, np.cumsum(counts)[:-1])
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket] * len(rows), pa.int32()), pa.array([r["block"] for r in rows], pa.int64()),
         pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())], names=["bucket", "block", "bits"])


def exchange(sent: DataFrame, bits: int) -> DataFrame:
    """The answers to all blocks, gathered by block; each range of hashes is one piece of work."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["bucket"] != held[0]["bucket"]:
                    yield _answers(held, bits)
                    held = []
                held.append(row)
        if held:
            yield _answers(held, bits)

    answered = sent.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(run, ANSWER)
    return answered.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))


def _answer_of(keys: np.ndarray, answers: list[dict] | None, bits: int) -> np.ndarray:
    """The bit of each distinct sorted key."""
    edges, out = _edges(keys, bits), np.zeros(len(keys), dtype=bool)
    for a in answers or ():
        i, j = edges[a["bucket"]], edges[a["bucket"] + 1]
        out[i:j] = _bits(a["bits"], j - i)
    return out


# ---- the passes over blocks -----------------------------------------------------------------------

def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _left_out(row: dict, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=bool)
    out[row["copies"] or []] = True
    return out


def _distinct_anchors(block: Block, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct anchors, which of them several documents have, the anchor of each position)."""
    anchors = block.anchors()
    at = np.flatnonzero(windows)
    if len(at):
        at = at[np.r_[True, (anchors[at[1:]] != anchors[at[:-1]]) | (block.nr[at[1:]] != block.nr[at[:-1]])]]
    order = at[np.argsort(anchors[at], kind="stable")]
    keys, nr = anchors[order], block.nr[order]
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, dtype=np.int64)
    several = nr[begin] != nr[np.r_[begin[1:], len(keys)] - 1] if len(keys) else np.empty(0, dtype=bool)
    return keys[begin], several, anchors


def _candidates(block: Block, row: dict, bits: int) -> np.ndarray:
    """Windows whose anchor occurs in several documents."""
    nobody = np.zeros(len(block.lengths), dtype=bool)
    keys, _, anchors = _distinct_anchors(block, block.windows(nobody))
    windows = block.windows(_left_out(row, len(block.lengths)))
    if not len(keys):
        return windows & False
    repeated = keys[_answer_of(keys, row["anchors"], bits)]
    return windows & np.isin(anchors, repeated)


def _distinct_nodes(block: Block, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct nodes of candidate windows, one context of each, which have several, the node of each position)."""
    nodes, contexts = block.runs(NODE), block.contexts()
    at = np.flatnonzero(candidates | np.r_[False, candidates[:-1]])
    order = at[np.argsort(nodes[at], kind="stable")]
    keys, around = nodes[order], contexts[order]
    if not len(keys):
        return keys, around, np.empty(0, dtype=bool), nodes
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    low, high = np.minimum.reduceat(around, begin), np.maximum.reduceat(around, begin)
    return keys[begin], low, low != high, nodes


def send_anchors(blocks: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block.of(row)
            keys, several, _ = _distinct_anchors(block, block.windows(np.zeros(len(block.lengths), dtype=bool)))
            yield _sent(row["block"], keys, None, several, bits)

    return blocks.select("block", "bodies", "sizes").mapInArrow(run, SENT)


def send_nodes(blocks: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block.of(row)
            keys, contexts, mixed, _ = _distinct_nodes(block, _candidates(block, row, bits))
            yield _sent(row["block"], keys, contexts, mixed, bits)

    return blocks.select("block", "bodies", "sizes", "anchors", "copies").mapInArrow(run, SENT)


def _paths_of(block: Block, row: dict, bits: int) -> Iterator[tuple]:
    """Nonbranching paths: runs of candidate windows, cut at nodes that branch."""
    candidates = _candidates(block, row, bits)
    keys, _, _, nodes = _distinct_nodes(block, candidates)
    if not len(keys):
        return
    branching = np.isin(nodes, keys[_answer_of(keys, row["nodes"], bits)])
    begins = candidates & (branching | ~np.r_[False, candidates[:-1]])
    at = np.flatnonzero(candidates)
    starts = np.flatnonzero(begins)
    counts = np.diff(np.r_[np.searchsorted(at, starts), len(at)])
    seen: dict[tuple, list[int]] = {}
    for start, n in zip(starts.tolist(), counts.tolist(), strict=True):
        digest = xxhash.xxh3_128_digest(b" ".join(block.words[start:start + n + NODE]))
        seen.setdefault((digest, int(block.nr[start]), n), []).append(start - int(block.begin[start]))
    for (digest, nr, n), inside in seen.items():
        high, low = np.frombuffer(digest, dtype=">i8").tolist()
        yield high, low, row["block"], nr, row["doc_ids"][nr], inside[0], inside, n


def paths(blocks: DataFrame, bits: int) -> DataFrame:
    """One row for each document and path in it."""
    schema = ("high", "low", "block", "nr", "doc_id", "first_start", "starts", "windows")
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            found = list(zip(*_paths_of(Block.of(row), row, bits), strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds, strict=True)], names=list(schema))

    return blocks.select("block", "bodies", "sizes", "doc_ids", "anchors", "copies", "nodes").mapInArrow(run, PATH)


def repeated_paths(found: DataFrame) -> DataFrame:
    """The paths that an earlier document has too, with the coordinates of their first occurrence."""
    known = F.coalesce("doc_id", F.lit(LAST_ID))
    first = found.groupBy("high", "low", "windows").agg(F.min(F.struct(known.alias("doc"), "first_start")).alias("source"))
    return found.join(first, ["high", "low", "windows"]).filter(known > F.col("source.doc")).select(
        "block", "nr", "doc_id", "starts", "windows", F.col("source.doc").alias("source_doc"),
        F.col("source.first_start").alias("source_start"))


def copies_of_earlier(blocks: DataFrame) -> DataFrame:
    """Per block the numbers of the documents whose words are all those of an earlier document."""
    docs = blocks.select("block", F.posexplode(F.arrays_zip("doc_ids", "n_words", "digests")).alias("nr", "d")).select(
        "block", "nr", F.coalesce("d.doc_ids", F.lit(LAST_ID)).alias("doc"), F.col("d.digests").alias("digest"),
        F.col("d.n_words").alias("n_words")).filter(F.col("n_words") >= WINDOW)
    # stored: a join of the two as they are read lets adaptive execution split a text with very many copies
    first = materialise(docs.groupBy("digest", "n_words").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("times")).filter(
        "times > 1").drop("times"), "first_copies")
    return docs.join(first, ["digest", "n_words"]).filter("doc > first").groupBy("block").agg(F.collect_list("nr").alias("copies"))


def _cleaned(row: dict) -> Iterator[tuple]:
    """Each document's words without those that a repeated path covers."""
    block, copies = Block.of(row), _left_out(row, len(row["doc_ids"]))
    covered = np.zeros(len(block.words) + 1, dtype=np.int64)
    spans = np.zeros(len(copies), dtype=np.int64)
    begins = np.cumsum(block.lengths) - block.lengths
    for path in row["paths"] or ():
        starts = begins[path["nr"]] + np.array(path["starts"], dtype=np.int64)
        np.add.at(covered, starts, 1)
        np.add.at(covered, starts + path["windows"] + NODE, -1)
        spans[path["nr"]] += len(starts)
    gone = np.cumsum(covered[:-1]) > 0
    for nr, doc_id in enumerate(row["doc_ids"]):
        i, j = int(begins[nr]), int(begins[nr] + block.lengths[nr])
        if copies[nr]:
            kept, spans[nr] = [], 1
        elif spans[nr]:
            kept = [w for w, g in zip(block.words[i:j], gone[i:j].tolist(), strict=True) if not g]
        else:
            kept = block.words[i:j]
        yield doc_id, j - i, j - i - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), int(spans[nr])


def _cleaned_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "n_spans"]
    for row in _rows(batches):
        columns = list(zip(*_cleaned(row), strict=True))
        if columns:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document the number of its words, how many of them were removed, and the digest of the rest."""
    spark = docs.sparkSession
    earlier = scratch_copies()
    name = f"substring_blocks_{uuid.uuid4().hex}"
    blocks = block_table(docs, scratch_path(spark, name), name)
    try:
        total = blocks.agg(F.sum(F.aggregate("n_words", F.lit(0).cast("bigint"), lambda a, n: a + n)).alias("n")).first()["n"] or 0
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        bits = math.ceil(math.log2(max(1, 2 * partitions, total / RANGE_WORDS)))
        python_batches(spark, 16)  # rows are blocks, or their share of a range
        copies = materialise(copies_of_earlier(blocks), "copies")
        anchors = materialise(exchange(send_anchors(blocks, bits), bits), "anchors")
        marked = blocks.join(anchors.withColumnRenamed("answers", "anchors"), "block", "left").join(copies, "block", "left")
        nodes = materialise(exchange(send_nodes(marked, bits), bits), "nodes")
        found = materialise(paths(marked.join(nodes.withColumnRenamed("answers", "nodes"), "block", "left"), bits), "paths")
        removed = repeated_paths(found).groupBy("block").agg(F.collect_list(F.struct("nr", "starts", "windows")).alias("paths"))
        cleaned = blocks.join(copies, "block", "left").join(removed, "block", "left").select(
            "block", "bodies", "sizes", "doc_ids", "copies", "paths").mapInArrow(_cleaned_batches, RESULT)
        return settled(cleaned, "cleaned", earlier)
    finally:
        python_batches(spark)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
