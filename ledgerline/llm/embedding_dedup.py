"""Embedding near-dedup by NN-descent.

Equal vectors become one node with a weight. Every node's neighbour list starts from random
projection trees: a tree's leaf holds vectors on the same side of random planes, and there
each takes its nearest. Then lists are refined by neighbours-of-neighbours joins: all that
have a node in their list, and all in its list, meet at that node and are compared with each
other, until few lists still change. Edges at or above the threshold are links, and their
components are formed.

A list that is full of links (saturated) may hide links to others. Such lists are enlarged
by looking past the own group: new trees compare saturated nodes with all nodes outside
their component, and links found merge components, until none is found. There a leaf is never
cut: one too large for a task is dealt as pairs of parts, in which any two of its nodes that lie
in different components meet. So a dense group costs no list of all its pairs, and it is not
closed off either. Every search first audits a
fixed number of nodes, drawn anew, against all vectors. A link that it finds outside the
components is added, and sends all nodes into the new trees; the search ends when ``QUIET``
audits and searches in a row find nothing. If that takes more than ``MAX_SEARCHES``, the job
fails with the share of audited nodes that still miss links. The number of trees follows their
depth, so that a pair at the threshold shares a leaf with probability ``SHARED`` at any size.

Each node's number of links is then counted exactly, in double precision, within its
component. In a large component, members within half the threshold's angle of one member
are linked to each other for sure and need no comparison; only the others are compared with
all members, in blocks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link
with nothing, neither do rows without a vec_id (their component is null and they aren't kept);
vectors of different length are never compared; rows of equal vec_id are judged one by one;
an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, python_batches, scratch_copies, settled
from ledgerline.llm.links import components

THRESHOLD = 0.95
#: length of a neighbour list
NEIGHBOURS = 10
#: least number of trees, and the probability that a pair at the threshold shares a leaf in one of them
TREES = 8
SHARED = 0.99
#: vectors in a leaf of a tree, about, and most that are compared at once
LEAF = 256
MEET = 512
#: rows in a part of a leaf whose parts are compared pair by pair
PART = 4096
#: rounds end when this share of list entries is new, or after so many
STILL_NEW = 0.02
MAX_ROUNDS = 5
#: nodes whose links a search audits against all vectors, other ones each time; the search ends after
#: so many audits and searches in a row that find nothing, and fails if it doesn't get there
AUDITED = 256
QUIET = 2
MAX_SEARCHES = 16
BATCH = 8_000


def usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(embedding.isNotNull() & (F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def unit(values: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision, also for very large and very small components."""
    values = values.astype(np.float64)
    values /= np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


class Vectors:
    """A list column whose rows are read group by group."""

    def __init__(self, column: pa.ChunkedArray):
        joined = column.combine_chunks()
        joined = joined.chunk(0) if isinstance(joined, pa.ChunkedArray) else joined
        self.offsets, self.values = joined.offsets.to_numpy(), joined.values.to_numpy(zero_copy_only=False)

    def units(self, i: int, j: int) -> np.ndarray:
        return unit(self.values[self.offsets[i]:self.offsets[j]].reshape(j - i, -1))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], Vectors, np.ndarray]]:
    """Columns, vectors and group boundaries of whole groups (``meet``); rows come ordered by group."""
    held: pa.Table | None = None
    for batch in _with_end(batches):
        if batch is not None:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            keys = held.column("meet").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
        else:
            cut = held.num_rows if held is not None else 0
        if not cut:
            continue
        whole, held = held.slice(0, cut), held.slice(cut)
        columns = {n: whole.column(n).to_numpy() for n in whole.column_names if n != "embedding"}
        keys = columns["meet"]
        yield columns, Vectors(whole.column("embedding")), np.r_[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), cut]


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


EDGE = "u bigint, v bigint, sim double"


def _edges(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    u, v, sim = (np.concatenate(c) for c in zip(*parts, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(sim)], names=["u", "v", "sim"])


def compared(rows: DataFrame, pairs: Callable[[dict, int, int, np.ndarray], tuple]) -> DataFrame:
    """Lets the rows of each ``meet`` be compared with each other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, vectors, edges in _groups(batches):
            parts = []
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if j - i > 1:
                    parts.append(pairs(columns, i, j, vectors.units(i, j)))
            if parts:
                yield _edges(parts)

    return rows.repartition("meet").sortWithinPartitions("meet").mapInArrow(run, EDGE)


def nearest(columns: dict, i: int, j: int, x: np.ndarray) -> tuple:
    """Each row's nearest others, as far as they beat the last entry of its list (``worst``, if given)."""
    node, sim = columns["node"][i:j], x @ x.T
    np.fill_diagonal(sim, -2.0)
    k = min(NEIGHBOURS, len(node) - 1)
    best = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    found = np.take_along_axis(sim, best, axis=1)
    wanted = found > (columns["worst"][i:j, None] if "worst" in columns else -2.0)
    wanted &= node[best] != node[:, None]
    row, column = np.nonzero(wanted)
    return node[row], node[best[row, column]], found[row, column]


def beyond(columns: dict, i: int, j: int, x: np.ndarray, threshold: float) -> tuple:
    """Links between a saturated row and rows outside its component, the nearest for each; ``MEET`` rows at once."""
    node, own = columns["node"][i:j], columns["component"][i:j]
    full = np.flatnonzero(columns["full"][i:j])
    found = []
    for start in range(0, len(full), MEET):
        row = full[start:start + MEET]
        sim = x[row] @ x.T
        sim[own[row][:, None] == own[None, :]] = -2.0
        best = np.argmax(sim, axis=1)
        value = sim[np.arange(len(row)), best]
        hit = np.flatnonzero(value >= threshold)
        found.append((node[row[hit]], node[best[hit]], value[hit]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (node[:0], node[:0], np.empty(0))


@functools.lru_cache(maxsize=8)
def _planes(seed: int, trees: int, bits: int, size: int) -> np.ndarray:
    return np.random.default_rng([seed, size]).standard_normal((size, trees * bits))


def depth(count: int) -> int:
    """Planes of a tree, for leaves of about ``LEAF`` nodes."""
    return max(0, math.ceil(math.log2(max(1, count / LEAF))))


def trees_for(count: int, threshold: float) -> int:
    """So many trees that two nodes at the threshold share a leaf of one with probability ``SHARED``."""
    together = (1 - math.acos(threshold) / math.pi) ** depth(count)
    return TREES if together >= 1 else max(TREES, math.ceil(math.log(1 - SHARED) / math.log1p(-together)))


def with_leaf(nodes: DataFrame, count: int, seed: int, trees: int) -> DataFrame:
    """Every node once for each tree, with ``tree`` and its ``leaf`` there."""
    bits = depth(count)
    names = nodes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, n = Vectors(pa.chunked_array([batch.column("embedding")])), batch.num_rows
            codes = np.zeros((n, trees), dtype=np.int64)
            sizes = np.diff(vectors.offsets)
            for size in np.unique(sizes).tolist() if bits else ():
                own = np.flatnonzero(sizes == size)
                x = np.stack([vectors.values[vectors.offsets[i]:vectors.offsets[i + 1]] for i in own]).astype(np.float64)
                side = (x @ _planes(seed, trees, bits, size) > 0).reshape(len(own), trees, bits)
                codes[own] = (side.astype(np.int64) << np.arange(bits, dtype=np.int64)).sum(axis=2)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * trees + 1, trees), pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), lists], names=[*names, "codes"])

    coded = nodes.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema) + ", codes array<bigint>")
    return coded.select(*names, F.posexplode("codes").alias("tree", "code")).withColumn(
        "leaf", F.xxhash64("tree", "code", F.size("embedding"))).drop("code")


def in_leaves(nodes: DataFrame, count: int, seed: int, trees: int) -> DataFrame:
    """Every node once for each tree, with its leaf as ``meet``; crowded leaves are dealt into parts by a hash."""
    return dealt(with_leaf(nodes, count, seed, trees), "leaf", F.xxhash64("node", "tree", F.lit(seed))).drop("tree")


def across_leaves(nodes: DataFrame, count: int, seed: int, trees: int) -> DataFrame:
    """``nodes`` with a ``meet`` such that any two of a leaf that lie in different components meet, however crowded it is.

    Leaves of more than ``PART`` rows become pairs of parts. A component with more rows than
    that has parts of its own, which need not meet each other; the rest share mixed parts. Rows
    of crowded leaves are ``full``: their first lists came from a part of the leaf only.
    """
    leaves = materialise(with_leaf(nodes, count, seed, trees).select("node", "component", "full", "leaf"), "leaves")
    sizes = leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), F.min("component").alias("least"), F.max("component").alias("most"))
    marked = leaves.join(sizes.filter("least < most").select("leaf", "rows"), "leaf").withColumn("full", F.col("full") | (F.col("rows") > MEET))
    whole = marked.filter(F.col("rows") <= PART).select("node", "full", F.col("leaf").alias("meet"))
    large = marked.filter(F.col("rows") > PART)
    cells = large.groupBy("leaf", "component").agg(F.count(F.lit(1)).alias("rows"))
    own = cells.filter(F.col("rows") > PART).select("leaf", "component", F.ceil(F.col("rows") / PART).alias("own_parts"))
    rest = cells.filter(F.col("rows") <= PART).groupBy("leaf").agg(F.ceil(F.sum("rows") / PART).alias("rest_parts"))
    key = F.xxhash64("leaf", F.col("owner").isNull(), "owner", "part")
    parts = own.select("leaf", F.col("component").alias("owner"), "own_parts").unionAll(
        rest.select("leaf", F.lit(None).cast("bigint"), "rest_parts")).select(
        "leaf", "owner", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("own_parts") - 1)).alias("part")).select(
        "leaf", "owner", key.alias("key"))
    parts = materialise(parts, "leaf_parts")
    others = parts.select("leaf", F.col("owner").alias("other_owner"), F.col("key").alias("other"))
    apart = F.col("owner").isNull() | ~F.col("owner").eqNullSafe(F.col("other_owner"))
    pairs = parts.join(others, "leaf").filter((F.col("key") <= F.col("other")) & apart).withColumn("meet", F.xxhash64("key", "other"))
    sides = pairs.select("key", "meet").unionAll(pairs.select("other", "meet")).distinct()
    placed = large.join(own, ["leaf", "component"], "left").join(rest, "leaf", "left").withColumn(
        "owner", F.when(F.col("own_parts").isNotNull(), F.col("component"))).withColumn(
        "part", F.pmod(F.xxhash64("node", F.lit("part")), F.coalesce("own_parts", "rest_parts")))
    met = placed.select("node", "full", key.alias("key")).join(sides, "key").select("node", "full", "meet")
    return whole.unionAll(met).join(nodes.select("node", "component", "embedding"), "node")




def dealt(rows: DataFrame, group: str, draw: Column) -> DataFrame:
    """``meet`` for each row: its group, in as many parts as keep a part near ``MEET`` rows."""
    crowded = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / F.lit(MEET)).alias("parts")).filter("parts > 1")
    parted = rows.join(crowded, group, "left")
    return parted.withColumn("meet", F.xxhash64(group, F.pmod(draw, F.coalesce("parts", F.lit(1))))).drop(group, "parts")


def best_of(edges: DataFrame) -> DataFrame:
    """Each node's list: its nearest, with ``fresh`` for entries that weren't in a list before."""
    once = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(W.partitionBy("u").orderBy(F.desc("sim"), "v"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= NEIGHBOURS)


def refined(nodes: DataFrame, lists: DataFrame, count: int) -> DataFrame:
    """Neighbours-of-neighbours joins until few lists change."""
    for round_ in range(MAX_ROUNDS):
        worst = lists.groupBy("u").agg(F.min("sim").alias("worst"), F.count(F.lit(1)).alias("n")).select(
            F.col("u").alias("node"), F.when(F.col("n") >= NEIGHBOURS, F.col("worst")).otherwise(-2.0).alias("worst"))
        # only nodes that some fresh edge touches can introduce anybody
        stirred = lists.filter("fresh").select(F.explode(F.array("u", "v")).alias("pivot")).distinct()
        members = lists.select(F.explode(F.array(F.struct(F.col("u").alias("pivot"), F.col("v").alias("node")),
                                                 F.struct(F.col("v").alias("pivot"), F.col("u").alias("node")))).alias("x")).select(
            "x.*").distinct().join(stirred, "pivot", "left_semi")
        meeting = dealt(members, "pivot", F.xxhash64("node", F.lit(round_)))
        rows = meeting.join(nodes.join(worst, "node", "left").select(
            "node", "embedding", F.coalesce("worst", F.lit(-2.0)).alias("worst")), "node")
        found = compared(rows, nearest).withColumn("fresh", F.lit(True))
        known = lists.select("u", "v", "sim", F.lit(False).alias("fresh"))
        lists = materialise(best_of(known.unionByName(found)), "neighbours")
        if lists.filter("fresh").count() <= STILL_NEW * NEIGHBOURS * count:
            break
    return lists


def labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` with ``component``, their own if they have no links."""
    found = components(links.select(F.col("u").alias("a"), F.col("v").alias("b")))
    return nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def audit(nodes: DataFrame, threshold: float, search: int) -> DataFrame:
    """Links (``v`` the audited end) missing from the components of ``AUDITED`` nodes, which are compared with all nodes.

    Every ``search`` draws its own nodes; each other node has one such link at most.
    """
    drawn = nodes.orderBy(F.xxhash64("node", F.lit("audit"), F.lit(search))).limit(AUDITED).select("node", "component", "embedding").collect()
    by_size: dict[int, tuple] = {}
    for size in {len(r["embedding"]) for r in drawn}:
        own = [r for r in drawn if len(r["embedding"]) == size]
        by_size[size] = (np.array([r["node"] for r in own]), np.array([r["component"] for r in own]),
                         unit(np.array([r["embedding"] for r in own], dtype=np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = Vectors(pa.chunked_array([batch.column("embedding")]))
            sizes, node, own = np.diff(vectors.offsets), batch.column("node").to_numpy(), batch.column("component").to_numpy()
            for size, (drawn_node, drawn_component, x) in by_size.items():
                rows = np.flatnonzero(sizes == size)
                if not len(rows):
                    continue
                y = unit(np.stack([vectors.values[vectors.offsets[i]:vectors.offsets[i + 1]] for i in rows]))
                sim = y @ x.T
                sim[own[rows][:, None] == drawn_component[None, :]] = -2.0
                best = np.argmax(sim, axis=1)
                value = sim[np.arange(len(rows)), best]
                hit = np.flatnonzero(value >= threshold)
                yield _edges([(node[rows[hit]], drawn_node[best[hit]], value[hit])])

    return nodes.select("node", "component", "embedding").mapInArrow(run, EDGE)


def find_links(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``nodes`` (``node``, ``n``, ``embedding``) with the ``component`` that links at or above the threshold form."""
    count = nodes.count()
    trees = trees_for(count, threshold)
    first = compared(in_leaves(nodes.select("node", "embedding"), count, 0, trees), nearest).withColumn("fresh", F.lit(True))
    lists = refined(nodes, materialise(best_of(first), "neighbours"), count)
    # a list whose last entry is a link may hide more
    full = materialise(lists.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("worst")).filter(
        (F.col("n") >= NEIGHBOURS) & (F.col("worst") >= threshold)).select(F.col("u").alias("node")), "saturated")
    links = lists.filter(F.col("sim") >= threshold).select("u", "v")
    saturated = not full.isEmpty()
    known = materialise(labelled(nodes, links), "components")
    quiet = 0
    for search in range(1, MAX_SEARCHES + 1):
        missing = materialise(audit(known, threshold, search).select("u", "v"), "audit")
        more = missing
        missed = not missing.isEmpty()
        if missed or saturated:
            # after a failed audit every list may have gaps, not only the saturated ones
            flagged = known.withColumn("full", F.lit(True)) if missed else known.join(
                full.withColumn("full", F.lit(True)), "node", "left").withColumn("full", F.coalesce("full", F.lit(False)))
            leaves = across_leaves(flagged.select("node", "embedding", "component", "full"), count, search, trees)
            past = compared(leaves, functools.partial(beyond, threshold=threshold)).select("u", "v")
            more = materialise(past.unionByName(missing).distinct(), "links_beyond")
        quiet = quiet + 1 if more.isEmpty() else 0
        # an audit of all nodes leaves nothing for another one
        if quiet >= QUIET or (quiet and count <= AUDITED):
            return known
        if not quiet:
            links = materialise(links.unionByName(more), "links")
            known = materialise(labelled(nodes, links), "components")
    gaps = missing.select("v").distinct().count()
    raise RuntimeError(f"links between components are still found after {MAX_SEARCHES} searches: "
                       f"{gaps} of the last {min(AUDITED, count)} audited vectors missed some")


def link_counts(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per node the weight of all members of its component within the threshold, itself included."""
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.min_by("embedding", "node").alias("middle"))
    sized = members.join(sizes, "component").filter("size > 1")
    whole = sized.filter(F.col("size") <= MEET).select("node", "n", "embedding", F.col("component").alias("meet"),
                                                      F.lit(True).alias("row_side"), F.lit(True).alias("column_side"))
    # members of a large component: near its first member (sure of each other) or not
    large = materialise(near_middle(sized.filter(F.col("size") > MEET).select("component", "node", "n", "embedding", "middle"), threshold), "large")
    parts = large.groupBy("component").agg(
        F.ceil(F.count(F.lit(1)) / MEET).cast("int").alias("all_parts"),
        F.ceil(F.sum((~F.col("near")).cast("int")) / MEET).cast("int").alias("far_parts"),
        F.sum(F.when(F.col("near"), F.col("n")).otherwise(0)).alias("near_n"))
    dealt_out = large.join(parts, "component")
    own_far, own_all = F.pmod(F.hash("node"), F.greatest("far_parts", F.lit(1))), F.pmod(F.hash("node"), F.col("all_parts"))
    meet = F.xxhash64("component", F.col("far_part"), F.col("all_part"))
    far = dealt_out.filter("not near").select("*", own_far.alias("far_part"), F.explode(F.sequence(F.lit(0), F.col("all_parts") - 1)).alias("all_part"))
    every = dealt_out.filter("far_parts > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("far_parts") - 1)).alias("far_part"), own_all.alias("all_part"))
    blocks = far.select("node", "n", "embedding", meet.alias("meet"), F.lit(True).alias("row_side"), F.lit(False).alias("column_side")).unionAll(
        every.select("node", "n", "embedding", meet.alias("meet"), F.col("near").alias("row_side"), F.lit(True).alias("column_side")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, vectors, edges in _groups(batches):
            nodes, sums = [], []
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                x, n = vectors.units(i, j), columns["n"][i:j]
                right, left = columns["column_side"][i:j], columns["row_side"][i:j]
                linked = x @ x.T >= threshold
                if left.all() and right.all():
                    np.fill_diagonal(linked, True)
                    total = linked @ n
                else:  # a block: rows that only count (far), columns that all are; near columns count the far rows
                    is_far = ~right
                    total = np.where(is_far, linked[:, right] @ n[right], 0)
                    near = right & left
                    total[near] = linked[np.ix_(near, is_far)] @ n[is_far]
                nodes.append(columns["node"][i:j][left]), sums.append(total[left])
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sums).astype(np.int64))], names=["node", "within"])

    rows = whole.unionByName(blocks)
    counted = rows.repartition("meet").sortWithinPartitions("meet").mapInArrow(run, "node bigint, within bigint")
    sure = large.filter("near").join(parts.select("component", "near_n"), "component").select("node", F.col("near_n").alias("within"))
    return counted.unionByName(sure).groupBy("node").agg(F.sum("within").alias("within"))


def near_middle(rows: DataFrame, threshold: float) -> DataFrame:
    """``near``: within half the threshold's angle of the component's first member, with a margin for rounding."""
    least = math.cos(math.acos(threshold) / 2) + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, middle = Vectors(pa.chunked_array([batch.column("embedding")])), Vectors(pa.chunked_array([batch.column("middle")]))
            near = [bool((own.units(i, i + 1) * middle.units(i, i + 1)).sum() >= least) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("component", "node", "n", "embedding")), pa.array(near, pa.bool_())],
                                             names=["component", "node", "n", "embedding", "near"])

    kind = rows.schema["embedding"].dataType.simpleString()
    return rows.mapInArrow(run, f"component bigint, node bigint, n bigint, embedding {kind}, near boolean")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``vectors`` (``vec_id``, ``embedding``): ``n_links``, ``component_id``, ``kept``."""
    spark, earlier = vectors.sparkSession, scratch_copies()
    python_batches(spark, BATCH)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").withColumn(
        "usable", usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    nodes = materialise(rows.filter("usable").groupBy("embedding").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("n")).select("node", "n", "embedding"), "vector_nodes")
    # rows of one vec_id and different vectors: the graph needs a node for each
    if nodes.groupBy("node").count().filter("count > 1").limit(1).count():
        nodes = materialise(nodes.withColumn("node", F.xxhash64("embedding")), "vector_nodes")
    known = find_links(nodes, threshold)
    counted = link_counts(known, threshold)
    least = rows.filter("usable").join(known.select("embedding", "component"), "embedding").groupBy("component").agg(F.min("vec_id").alias("component_id"))
    judged = materialise(known.join(least, "component").join(counted, "node", "left").select(
        "embedding", "component_id", F.coalesce(F.col("within"), F.col("n")).alias("within")), "judged")
    out = rows.join(judged.withColumn("usable", F.lit(True)), ["embedding", "usable"], "left").select(
        "vec_id", F.coalesce(F.col("within") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    result = settled(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))), "near_vectors", earlier)
    python_batches(spark)
    return result
