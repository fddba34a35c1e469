"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Each source is a queue of its documents in shuffled order, gone through up to ``epochs`` times. A document's
virtual finish time is the source's words up to and with it, divided by the source's target. All documents are
range-sorted by that time and taken until the total budget is full: every source is served in proportion.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, cut
from .sharding import with_slots


#: Sources up to which their thresholds (a row each) are broadcast to the documents; more are joined by a shuffle.
BROADCAST_SOURCES = 100_000


@dataclass(frozen=True)
class MixPlan:
    """Weights go to the sources in order of their names, repeating; the budget is ``budget`` times all sizes."""

    weights: tuple[int, ...] = (5, 2, 1)
    budget: float = 1.5
    epochs: int = 2
    seed: str = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.filter(F.split(text, f"{SPACE_CLASS}+"), lambda w: w != "")), F.lit(0)).cast("long")


def _queue_key() -> Column:
    return F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("source")))


def _measured(docs: DataFrame, key: str, text: str, source: str, plan: MixPlan, row: Column | None = None) -> DataFrame:
    """Columns id, source, q (the source as a key that is never null), size, h (place in the shuffle, hex) and b (its
    first digits: 4096 parts of a queue). The place is of id and text, so many rows of one id, or none, spread over all parts."""
    h = F.md5(F.concat(F.md5(F.concat_ws(":", F.lit(plan.seed), F.coalesce(F.col(key).cast("string"), F.lit("")))), F.md5(F.coalesce(F.col(text), F.lit("")))))
    size = F.when(F.col(text).isNull(), F.lit(0).cast("long")).otherwise(word_count(F.col(text)))
    out = docs.select(F.col(key).alias("id"), F.col(source).alias("source"), size.alias("size"), h.alias("h"), *([row.alias("row")] if row is not None else []))
    return out.withColumn("b", F.substring("h", 1, 3)).withColumn("q", _queue_key())


def source_targets(measured: DataFrame, plan: MixPlan) -> DataFrame:
    """One row per source: name, words, weight, target.

    Sharing the budget by weight, stopping a source at ``epochs`` times its words and sharing the excess again ends
    where target = min(epochs x words, level x weight); the level follows from sums over sources in order of
    words / weight. The table has one row per source, so its ordered windows see no documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in plan.weights])
    sources = measured.groupBy("source").agg(F.sum("size").alias("words"))
    ranked = sources.withColumn("rank", F.row_number().over(by_name) - 1)
    weighted = ranked.withColumn("weight", F.get(weights, F.col("rank") % len(plan.weights))).withColumn("top", plan.epochs * F.col("words"))
    full_first = Window.orderBy(F.col("top") / F.col("weight"), "rank")
    sums = weighted.select(
        "*", F.sum("words").over(Window.partitionBy()).alias("all_words"),
        F.coalesce(F.sum("top").over(full_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("top_before"),
        F.sum("weight").over(full_first.rowsBetween(0, Window.unboundedFollowing)).alias("weight_left"),
    )
    # If this source is the first that isn't full, the level is what is left of the budget by the weight left.
    level = sums.withColumn("level", (F.lit(plan.budget) * F.col("all_words") - F.col("top_before")) / F.col("weight_left"))
    first_open = F.min(F.when(F.col("level") * F.col("weight") <= F.col("top"), F.struct(F.col("top") / F.col("weight"), F.col("rank"), F.col("level")))).over(Window.partitionBy())
    settled = level.withColumn("common", first_open["level"])
    target = F.coalesce(F.least(F.col("top").cast("double"), F.col("common") * F.col("weight")), F.col("top").cast("double"))
    return settled.select(_queue_key().alias("tq"), "rank", F.col("words").alias("source_size"), "weight", target.alias("target"))


def _queued(measured: DataFrame, targets: DataFrame) -> DataFrame:
    """``measured`` with its source's row and ``cum``: words of the queue up to and with the document.

    A queue is cut into 4096 parts by the shuffle's first digits; sums of the parts (a bounded table per source)
    give each part its start, so that no task has to hold a whole source.
    """
    parts = measured.groupBy(F.col("q").alias("pq"), F.col("b").alias("pb")).agg(F.sum("size").alias("part"))
    ahead = Window.partitionBy("pq").orderBy("pb").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("pq", "pb", F.coalesce(F.sum("part").over(ahead), F.lit(0)).alias("start")).join(targets, F.col("pq") == F.col("tq")).drop("tq")
    inside = Window.partitionBy("q", "b").orderBy("h", "size").rowsBetween(Window.unboundedPreceding, 0)
    run = measured.withColumn("run", F.sum("size").over(inside))
    joined = run.join(starts, (F.col("q") == F.col("pq")) & (F.col("b") == F.col("pb")))
    return joined.withColumn("cum", F.col("start") + F.col("run")).drop("b", "pq", "pb", "start", "run")


def _finish(epoch: Column | int) -> Column:
    """Virtual finish time of a document's ``epoch``-th turn, counted from 0."""
    return (F.col("cum") + F.lit(epoch) * F.col("source_size") if isinstance(epoch, int) else F.col("cum") + epoch * F.col("source_size")) / F.col("target")


def _last_taken(queue: DataFrame, plan: MixPlan) -> tuple[float, int]:
    """(finish time, source rank) of the last turn that fits the budget, by a global range sort.

    Turns are dealt to range partitions by finish time; the partitions' sums, in order, tell where the budget ends;
    a running sum inside the partitions finds the turn.
    """
    turns = queue.where("size > 0").select("size", "rank", "all_words", F.explode(F.array([F.struct(_finish(e).alias("v")) for e in range(plan.epochs)])).alias("x")).select("size", "rank", "all_words", F.col("x.v").alias("v"))
    sorted_turns = cut(turns.repartitionByRange(F.col("v"), F.col("rank")).withColumn("pid", F.spark_partition_id()), "turns")
    sums = sorted_turns.groupBy("pid").agg(F.sum("size").alias("part"))
    before = sums.select(F.col("pid").alias("p"), F.coalesce(F.sum("part").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    inside = Window.partitionBy("pid").orderBy("v", "rank").rowsBetween(Window.unboundedPreceding, 0)
    running = sorted_turns.withColumn("run", F.sum("size").over(inside)).join(before, F.col("pid") == F.col("p"))
    fits = running.where(F.col("start") + F.col("run") <= F.lit(plan.budget) * F.col("all_words"))
    last = fits.agg(F.max(F.struct("v", "rank")).alias("last")).first()["last"]
    return (last["v"], last["rank"]) if last else (-1.0, -1)


def _turns_taken(plan: MixPlan, last: tuple[float, int]) -> Column:
    """How many turns of a document come no later than the last one that fits."""
    v, rank = last
    turns = [(F.struct(_finish(e).alias("v"), F.col("rank")) <= F.struct(F.lit(v).alias("v"), F.lit(rank).alias("rank"))).cast("int") for e in range(plan.epochs)]
    return F.when(F.col("size") > 0, sum(turns[1:], turns[0])).otherwise(F.lit(0))


def _planned(measured: DataFrame, plan: MixPlan) -> tuple[DataFrame, tuple[float, int]]:
    """The queue, and the last turn taken, from rows without their texts."""
    skinny = cut(measured.select("id", "source", "q", "size", "h", "b"), "sizes")
    total = skinny.agg(F.sum("size").alias("n")).first()["n"] or 0
    targets = cut(source_targets(skinny, plan).withColumn("all_words", F.lit(total).cast("long")), "targets")
    queue = cut(_queued(skinny, targets), "queue")
    return queue, _last_taken(queue, plan)


def mix_table(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", plan: MixPlan | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words the mix takes, repeats counted).

    A null or empty text has size 0 and is not taken; a null source is a source, the last one; equal rows are
    interchangeable; an empty table gives an empty one; reruns agree.
    """
    plan = plan or MixPlan()
    queue, last = _planned(_measured(docs, key, text, source, plan), plan)
    taken = (F.col("size") * _turns_taken(plan, last)).cast("long")
    return queue.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"))


def _thresholds(queue: DataFrame, last: tuple[float, int], plan: MixPlan) -> DataFrame:
    """One row a source: tq, and for each turn e the last place taken, t<e>, and how many rows are taken there, k<e>.

    A source is taken in the order of its queue, so a place (h, size) says it all; only rows that are equal in id and text
    share one, and of these some may be taken and others not.
    """
    turns = range(plan.epochs)
    place = F.struct("h", "size")
    took = queue.withColumn("n", _turns_taken(plan, last)).where("n > 0")
    ends = took.groupBy(F.col("q").alias("tq")).agg(*[F.max(F.when(F.col("n") > e, place)).alias(f"t{e}") for e in turns])
    met = took.join(_by_source(ends), F.col("q") == F.col("tq"))
    return met.groupBy("tq").agg(*[f for e in turns for f in (F.max(f"t{e}").alias(f"t{e}"), F.count(F.when((F.col("n") > e) & (place == F.col(f"t{e}")), 1)).alias(f"k{e}"))])


def _by_source(table: DataFrame) -> DataFrame:
    table = cut(table, "sources")
    return F.broadcast(table) if table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else table


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", plan: MixPlan | None = None) -> DataFrame:
    """The mixed corpus: rows of ``docs`` as often as the mix takes them, with the columns of ``docs``.

    A document of no words is no loss to any target and stays once; of rows that are equal in id and text as many are
    taken as ``mix_table`` says; a null source is a source; an empty table gives an empty one. Documents are not moved: a
    row's place in its source's queue is compared with the places where the mix ends. Only rows at those very places are
    numbered, in a table of their own.
    """
    plan = plan or MixPlan()
    measured = _measured(docs, key, text, source, plan, F.struct("*"))
    queue, last = _planned(measured, plan)
    turns, place = range(plan.epochs), F.struct("h", "size")
    placed = measured.join(_by_source(_thresholds(queue, last, plan)), F.col("q") == F.col("tq"), "left").withColumn("place", place)
    at_end = F.lit(False)
    for e in turns:
        at_end = at_end | F.coalesce(F.col("place") == F.col(f"t{e}"), F.lit(False))
    before = [F.coalesce((F.col("place") < F.col(f"t{e}")).cast("int"), F.lit(0)) for e in turns]
    inside = placed.where(~at_end).withColumn("n", F.when(F.col("size") == 0, F.lit(1)).otherwise(sum(before[1:], before[0])))
    edge = cut(placed.where(at_end).withColumn("order", F.monotonically_increasing_id()), "edge")
    counted = with_slots(edge.withColumn("group", F.concat("q", F.lit("/"), "h")), "group", ["order"])
    here = [F.when(F.coalesce(F.col("place") == F.col(f"t{e}"), F.lit(False)), (F.col("slot") < F.col(f"k{e}")).cast("int")).otherwise(before[e]) for e in turns]
    edges = counted.withColumn("n", sum(here[1:], here[0]))
    both = inside.select("row", "n").unionAll(edges.select("row", "n"))
    return both.where("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")
