"""Mixing sources to target weights by weighted sampling without replacement.

Each source gets its weight's share of all words, but at most ``MAX_EPOCHS`` times its own
words; what a capped source can't take goes to the others by weight. A source's target is
met by complete epochs first (every document that many times) and then by a weighted sample
for the fraction that is left: each document draws an exponential key divided by its quality
weight, documents are sorted by key within their source, and the prefix of sizes up to the
budget is taken. The document at the edge is taken if at least half of it fits.

The prefix sums need no sorted source in one task. Keys are cut into 4,096 cells, the cells'
sums tell in which cell the budget ends, that cell is cut into 4,096 again, and only the rows
of this last cell are sorted. What remains is one cut point per source, and whether a row is
taken is a comparison with it. The tables of sources hold one row per source.

Draws are hashes of the doc_id, so reruns agree whatever the partitioning.

Defined cases: a null text has size 0; a null source is a source of its own, the last; a null
doc_id draws like any other value; rows of equal doc_id, source and size share a draw and are
taken or left together; sources without words have the target 0; an empty table gives an
empty result. A document's quality weight falls with its symbols per word, never to zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, carried, materialise, restored

#: weights of the sources in code point order, repeated
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SYMBOLS = "#*$%&|<>"
MIN_QUALITY = 0.1
#: bits of a sampling position, and of the position inside the two levels of cells
POSITION_BITS, CELL_BITS, INNER_BITS = 44, 32, 20


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("bigint")


def quality_weight(text: Column, size: Column) -> Column:
    """1 for a text without symbols, less by their share of the words, at least ``MIN_QUALITY``."""
    plain = F.coalesce(text.cast("string"), F.lit(""))
    symbols = F.length(plain) - F.length(F.translate(plain, SYMBOLS, ""))
    return F.greatest(F.lit(MIN_QUALITY), 1 - symbols / F.greatest(size, F.lit(1)).cast("double"))


def position(doc_id: Column, weight: Column) -> Column:
    """Where the document's exponential key lies among all keys, as an integer.

    With u uniform the key is -ln(u) / weight; 1 - exp(-key) = 1 - u ** (1 / weight) rises
    with it and lies between 0 and 1.
    """
    digits = F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    return F.floor((1 - F.pow(u, 1 / weight)) * F.lit(float(1 << POSITION_BITS))).cast("bigint")


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``mix_size`` and ``mix_at``."""
    return docs.withColumn("mix_size", word_count(F.col("text"))).withColumn(
        "mix_at", position(F.col("doc_id"), quality_weight(F.col("text"), F.col("mix_size"))))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: its words, its target, the complete epochs and the words that a sample must add.

    In the order of cap per weight, a source is capped if the share that is left for it and
    those after it exceeds its cap; once one isn't, none after it is.
    """
    sources = rows.groupBy("source").agg(F.sum("mix_size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = sources.select("source", "source_size", rank.alias("rank"), weight.alias("weight"),
                            (F.col("source_size") * max_epochs).cast("double").alias("cap"))
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    levels = ranked.select(
        "*", ((F.sum("source_size").over(W.partitionBy()).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              / F.sum("weight").over(by_cap.rowsBetween(0, W.unboundedFollowing))).alias("level"))
    capped = F.col("cap") / F.col("weight") < F.col("level")
    shared = levels.withColumn("capped", capped).withColumn(
        "share", F.max(F.when(~F.col("capped"), F.col("level"))).over(W.partitionBy()))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("share"))
    filled = shared.select("source", "source_size", target.alias("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    return filled.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))


def _cell_at_budget(cells: DataFrame, cell: str) -> DataFrame:
    """Per source the cell in which the budget ends, and the words before it."""
    upto = W.partitionBy("source").orderBy(cell)
    summed = cells.withColumn("upto", F.sum("words").over(upto))
    return summed.filter((F.col("upto") - F.col("words") < F.col("rest")) & (F.col("upto") >= F.col("rest")) & (F.col("rest") > 0)).select(
        "source", "rest", cell, (F.col("upto") - F.col("words")).alias("before"))


def cut_points(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with the place where each source's sample ends: all before ``cell_start``, and up to ``last``."""
    def same_source(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b.withColumnRenamed("source", "own_source"), F.col("source").eqNullSafe(F.col("own_source"))).drop("own_source")

    outer, inner = F.shiftright("mix_at", CELL_BITS), F.shiftright("mix_at", INNER_BITS)
    budget = wanted.select("source", "rest")
    first = _cell_at_budget(same_source(
        rows.groupBy("source", outer.alias("outer")).agg(F.sum("mix_size").alias("words")), budget), "outer")
    in_first = same_source(rows, first.withColumnRenamed("outer", "at_outer")).filter(outer == F.col("at_outer"))
    second = _cell_at_budget(in_first.groupBy("source", inner.alias("inner")).agg(
        F.sum("mix_size").alias("words"), F.first("before").alias("earlier"), F.first("rest").alias("whole")).select(
        "source", "inner", "words", "earlier", (F.col("whole") - F.col("earlier")).alias("rest")), "inner")
    in_second = same_source(rows, second.withColumnRenamed("inner", "at_inner")).filter(inner == F.col("at_inner"))
    place = F.struct("mix_at", _known(F.col("doc_id")).alias("doc"), "mix_size")
    bundles = in_second.groupBy("source", place.alias("place")).agg(
        F.sum("mix_size").alias("words"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    upto = F.sum("words").over(W.partitionBy("source").orderBy("place"))
    last = bundles.withColumn("upto", upto + F.col("before")).filter(
        F.col("upto") - F.col("words") / 2 <= F.col("rest")).groupBy("source").agg(F.max("place").alias("last"))
    ends = second.select("source", F.shiftleft("inner", INNER_BITS).alias("cell_start"))
    known = wanted.join(ends.withColumnRenamed("source", "end_source"), F.col("source").eqNullSafe(F.col("end_source")), "left").drop("end_source")
    return known.join(last.withColumnRenamed("source", "last_source"), F.col("source").eqNullSafe(F.col("last_source")), "left").drop("last_source")


def _known(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("bigint"), F.lit(-(1 << 63)))


def with_copies(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` (as ``sized`` gives them) with ``copies``, the times the mix takes them."""
    place = F.struct("mix_at", _known(F.col("doc_id")).alias("doc"), "mix_size")
    in_sample = F.coalesce((F.col("mix_at") < F.col("cell_start")) | (place <= F.col("last")), F.lit(False))
    joined = rows.join(cuts.withColumnRenamed("source", "cut_source"), F.col("source").eqNullSafe(F.col("cut_source")))
    # a target that rounding puts a hair above its cap asks for no further epoch
    return joined.withColumn("copies", F.least(F.col("epochs") + in_sample.cast("bigint"), F.lit(MAX_EPOCHS).cast("bigint")))


def plan_mix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sizes and draws of all documents, written once, and each source's cut point."""
    rows = materialise(sized(docs.select("doc_id", "text", "source")).drop("text"), "mix_sizes")
    return rows, materialise(cut_points(rows, targets(rows)), "mix_cuts")


def mix(docs: DataFrame) -> DataFrame:
    """Per document its size, its source's size and target, and the words that the mix takes of it."""
    rows, cuts = plan_mix(docs)
    return with_copies(rows, cuts).select(
        "doc_id", F.col("mix_size").alias("size"), "source_size", "target",
        (F.col("mix_size") * F.col("copies")).alias("taken"), "source", "copies")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix themselves, each as many times as it is taken, in the columns of ``docs``."""
    _, cuts = plan_mix(docs)
    taken = with_copies(sized(carried(docs, "doc_id", "text", "source")), cuts).filter("copies > 0")
    return restored(taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs.columns)
