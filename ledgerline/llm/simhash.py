"""SimHash near-dedup: fingerprints of 64 bits, searched through sharded vantage-point trees.

Two fingerprints within ``MAX_BITS`` (3) bits agree in at least one of four bands of 16 bits:
there their distance is zero. So the first level of the tree needs no overlap: each band's
fingerprints go to the shard of their band value, four shards for each fingerprint. A shard
with more than ``SHARD_ROWS`` fingerprints is split further, in Spark: one of its members
becomes the vantage point, the others are dealt to cells by their Hamming distance to it, and
by the triangle inequality a fingerprint can only be linked to such whose distance differs by
at most 3. It therefore joins the cells that reach down to 3 below its own distance, and no
pair is lost at a boundary. Levels follow as long as they save comparisons. A shard whose
members are all near each other can't be pruned: it is searched in windows of the distance
to a vantage point, and if it is too large for a task, as all pairs of its parts.

Equal fingerprints are one node from the start, and each shard returns a spanning forest of
its links rather than all pairs; the components of all forests together are found in Spark.

Defined cases: a null or empty text has the fingerprint zero, which links like any other; a
null doc_id has a fingerprint but never names a component that has another doc_id; repeated
rows come out alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import carried, materialise, python_batches, restored, scratch_copies, settled, text_bytes
from ledgerline.llm.links import components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
BANDS = 4
SHARD_ROWS = 256
MAX_LEVELS = 12
#: half of what a task searches at most
TASK_ROWS = 8_192
#: rows of a numeric Arrow batch, and shingles whose bits are unpacked at once
NUMBER_ROWS = 50_000
CHUNK = 1 << 16


def fingerprint(text: bytes, words_each: int = SHINGLE_WORDS) -> int:
    """Bit i is set if more than half of the shingles' hashes have it; signed, as Spark stores it."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) < words_each:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*[words[i:] for i in range(words_each)], strict=False)))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8", count=len(shingles))
    set_bits = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = hashes[i:i + CHUNK].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words_each: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fp`` of every document."""
    python_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = pa.array([fingerprint(t, words_each) for t in text_bytes(batch.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), fp], names=["doc_id", "text_hash", "fp"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash")).mapInArrow(
        run, "doc_id bigint, text_hash bigint, fp bigint")


def band_shards(distinct: DataFrame) -> DataFrame:
    """First level: a fingerprint's four shards."""
    width = 64 // BANDS
    values = [F.xxhash64(F.lit(i), F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit((1 << width) - 1))) for i in range(BANDS)]
    return distinct.select("fp", F.explode(F.array(*values)).alias("shard"))


def split_shards(shards: DataFrame, max_bits: int, shard_rows: int) -> tuple[DataFrame, DataFrame]:
    """(shards small enough, those that were split by the distance to a vantage point)."""
    counted = shards.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"), F.min_by("fp", F.xxhash64("fp", "shard")).alias("vantage"))
    large = counted.filter(F.col("rows") > shard_rows)
    small = shards.join(large.select("shard"), "shard", "left_anti")
    away = F.bit_count(F.col("fp").bitwiseXOR(F.col("vantage"))).cast("int")
    measured = shards.join(large, "shard").select("shard", "rows", "fp", away.alias("distance"))
    at = measured.groupBy("shard", "distance").agg(F.count(F.lit(1)).alias("n"))
    # per shard at most 65 distances: cells of neighbouring distances with about shard_rows members
    at = at.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("distance", "n"))).alias("by_distance")).select(
        "shard", F.posexplode(F.transform("by_distance", lambda x, i: F.struct(
            x["distance"].alias("distance"),
            F.aggregate(F.slice("by_distance", F.lit(1), i), F.lit(0).cast("bigint"), lambda acc, y: acc + y["n"]).alias("before")))).alias("i", "x")).select(
        "shard", F.col("x.distance").alias("cell_distance"), F.floor(F.col("x.before") / F.lit(shard_rows)).alias("cell"))
    reached = measured.select("shard", "fp", F.explode(F.sequence(
        F.greatest(F.col("distance") - max_bits, F.lit(0)), F.col("distance"))).alias("cell_distance"))
    placed = reached.join(at, ["shard", "cell_distance"]).select("fp", F.xxhash64("shard", "cell").alias("shard")).distinct()
    return small, placed


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least reachable index of each of n nodes."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while (label[label] != label).any():
            label = label[label]
        if (before == label).all():
            break
    return label


def linked_in_shards(shard: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, its root) that span each shard's components; rows are ordered by shard."""
    edges_a, edges_b = [], []
    starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    sizes = np.diff(np.r_[starts, len(shard)])
    size_of = np.repeat(sizes, sizes)
    small = size_of <= SHARD_ROWS
    rows = np.arange(len(shard))
    last = np.repeat(starts + sizes, sizes)
    here = rows[small]
    for step in range(1, int(sizes[sizes <= SHARD_ROWS].max(initial=1))):  # all pairs of small shards, by offset
        here = here[here + step < last[here]]
        near = np.bitwise_count(fp[here] ^ fp[here + step]) <= max_bits
        edges_a.append(here[near]), edges_b.append(here[near] + step)
    for start, size in zip(starts[sizes > SHARD_ROWS], sizes[sizes > SHARD_ROWS], strict=True):
        a, b = _windows(fp[start:start + size], max_bits)
        edges_a.append(a + start), edges_b.append(b + start)
    if not edges_a:
        return fp[:0], fp[:0]
    root = _forest(np.concatenate(edges_a), np.concatenate(edges_b), len(fp))
    member = root != rows
    return fp[member], fp[root[member]]


def _windows(fp: np.ndarray, max_bits: int, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """A forest of one large shard: each block meets only those whose distance to the vantage point is near."""
    distance = np.bitwise_count(fp ^ fp[0]).astype(np.int64)
    order = np.argsort(distance, kind="stable")
    sorted_fp, sorted_distance = fp[order], distance[order]
    label = np.arange(len(fp))
    for i in range(0, len(fp), block):
        j = min(i + block, len(fp))
        end = int(np.searchsorted(sorted_distance, sorted_distance[j - 1] + max_bits, side="right"))
        near = np.bitwise_count(sorted_fp[i:j, None] ^ sorted_fp[None, i:end]) <= max_bits
        a, b = np.nonzero(near)
        label = _forest(np.r_[np.arange(len(fp)), a + i], np.r_[label, b + i], len(fp))
    return order, order[label]


def shard_links(shards: DataFrame, max_bits: int) -> DataFrame:
    """Links ``a``, ``b`` of fingerprints, a spanning forest for each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in _and_end(batches):
            if batch is not None:
                shard = np.concatenate([shard, batch.column("shard").to_numpy()])
                fp = np.concatenate([fp, batch.column("fp").to_numpy().view(np.uint64)])
                whole = int(np.searchsorted(shard, shard[-1])) if len(shard) else 0  # the last shard may go on
            else:
                whole = len(shard)
            if whole:
                a, b = linked_in_shards(shard[:whole], fp[:whole], max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
                shard, fp = shard[whole:], fp[whole:]

    return shards.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "a bigint, b bigint")


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def pair_cost(shards: DataFrame, above: int) -> float:
    """The comparisons in shards of more than ``above`` rows, about."""
    n = F.col("count").cast("double")
    return shards.groupBy("shard").count().filter(F.col("count") > above).agg(F.sum(n * n).alias("cost")).first()["cost"] or 0.0


def dealt_pairs(shards: DataFrame, task_rows: int) -> DataFrame:
    """Shards too large for a task, as all pairs of their parts: every two rows meet in some part, none larger than two."""
    large = shards.groupBy("shard").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 2 * task_rows).select(
        "shard", F.ceil(F.col("rows") / task_rows).cast("int").alias("parts"))
    marked = shards.join(large, "shard", "left")
    own = F.pmod(F.xxhash64("fp", F.lit("part")), F.col("parts")).cast("int")
    split = marked.filter("parts is not null").select("fp", "shard", own.alias("own"), F.explode(
        F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select(
        "fp", F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other")).alias("shard"))
    return marked.filter("parts is null").select("fp", "shard").unionAll(split)


def near_links(
    distinct: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Links between the distinct fingerprints, spanning every component of those within ``max_bits``."""
    if not 0 <= max_bits < BANDS:
        raise ValueError(f"{BANDS} bands find distances below {BANDS}")
    shards = materialise(band_shards(distinct), "fp_shards")
    parts, cost = [], pair_cost(shards, shard_rows)
    for _ in range(MAX_LEVELS):
        if not cost:
            break
        small, placed = split_shards(shards, max_bits, shard_rows)
        placed = materialise(placed, "fp_shards")
        after = pair_cost(placed, 0)
        if after >= cost:  # all are near each other: cells that overlap this much save nothing
            break
        parts.append(small)
        shards, cost = placed, pair_cost(placed, shard_rows)
    shards = dealt_pairs(shards, task_rows)
    python_batches(distinct.sparkSession, NUMBER_ROWS)
    found = None
    for part in [*parts, shards]:
        links = shard_links(part, max_bits)
        found = links if found is None else found.unionAll(links)
    found = materialise(found.distinct(), "fp_links")
    python_batches(distinct.sparkSession)
    return found


def grouped(docs: DataFrame, words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp`` and ``component_id``, the least doc_id that links reach."""
    earlier = scratch_copies()
    rows = materialise(fingerprints(docs, words_each), "fingerprints")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp_distinct")
    component = components(near_links(distinct.select("fp"), max_bits))
    named = distinct.join(component.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_fp = named.join(least, "component").select("fp", "component", "component_id")
    return settled(rows.join(of_fp, "fp").select("doc_id", "text_hash", "fp", "component", "component_id"), "near_groups", earlier)


def near_duplicates(docs: DataFrame, words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    return grouped(docs, words_each, max_bits).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each group: that with the least doc_id, null last, then by text."""
    groups = grouped(docs, words_each, max_bits)
    first = groups.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")).alias("kept")).select(
        F.coalesce("kept.doc_id", F.lit(-1)).alias("near_id"), F.col("kept.unknown").alias("near_unknown"),
        F.col("kept.text_hash").alias("near_hash"))
    keys = ["near_id", "near_unknown", "near_hash"]
    keyed = carried(docs, "doc_id", "text").select(
        "carried_row", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1)).alias("near_id"),
        F.col("doc_id").isNull().alias("near_unknown"), F.xxhash64(F.col("text").cast("string")).alias("near_hash"))
    return restored(keyed.join(first, keys, "left_semi").dropDuplicates(keys), docs.columns)
