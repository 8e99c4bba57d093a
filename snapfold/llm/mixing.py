"""Mixing sources to target weights by weighted fair queueing.

Every source offers its documents in a shuffled order, `copies` times over.  A
document's virtual finish time is the number of its source's words up to and with it,
divided by the source's target.  All documents are range-sorted by finish time and served in that
order until the total budget is used up, which keeps the sources in proportion at any moment.

The one document of a source that runs over its target is served in two parts, of which
the first ends where the source has given its target, at time 1 (`taken`).  So no long
document keeps its source from its target, and the budget ends at time 1 as well.  With `whole`
such a document is taken or left, whichever is nearer.

Running sums never pass through one task.  In a source, documents are dealt to slots by the leading
bits of their shuffle key, sums of slots are added up, and a document's sum is its
slot's plus what precedes it in the slot; the number of slots grows with the source's
documents, so a source with a third of all rows is cut finely.  Over all sources, the same is
done with the ranges of the global sort.

Null text: size 0.  Null sources are a source of their own, last.  Documents of
size 0 take part with 0 words.  Rows with the same doc_id, source and size stand side by
side in the queue; each is a document of its own in `mixed_amounts`, while `mixture` serves them together.
An empty table gives an empty mix.  Other columns play no part and are carried along.

The targets are broadcast up to BROADCAST_SOURCES sources; beyond that Spark joins them
as it sees fit, with the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.llm.staging import staged
from snapfold.llm.textcols import n_words

COPIES = 2
SHARE = 1.5
WEIGHTS = (5, 2, 1)
SLOT_ROWS = 2000
RANGE_ROWS = 250_000
BROADCAST_SOURCES = 50_000


def source_targets(sizes: DataFrame, share: float = SHARE, weights=WEIGHTS, copies: int = COPIES) -> DataFrame:
    """One row per source: source, rows, source_size, target.

    Sources in code-point order, null last, get the weights in turn.  Targets beyond
    `copies` times a source's size stop there and the excess is shared by weight, until
    none is above: the share per unit of weight rises to the level where the capped
    sources and the rest together use the budget.  Sorted by cap / weight, the capped
    sources are a prefix.  The level is that of the first source behind it; of later ones, before
    which sources that are not capped would count as if they were, it is lower.
    """
    totals = sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    totals = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(copies)))
    budget = F.sum("source_size").over(every) * F.lit(share)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(
        fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    capped = F.col("level") * F.col("weight") >= F.col("cap")
    rest = F.max(F.when(~capped, F.col("level"))).over(every)
    return (
        totals.withColumn("budget", budget)
        .withColumn("level", level)
        .withColumn("target", F.when(capped, F.col("cap")).otherwise(rest * F.col("weight")))
        .select("source", "rows", "source_size", "target")
    )


def shuffle_key(doc_id: Column, copy: Column, seed: int) -> Column:
    """A fixed pseudo-random key: reruns agree."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), copy.cast("string"), doc_id.cast("string")))


def fair_queue(docs: DataFrame, seed: int = 7, share: float = SHARE, weights=WEIGHTS, copies: int = COPIES,
               whole: bool = False, slot_rows: int = SLOT_ROWS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """row, doc_id, source, copy, size, source_size, target, finish (virtual time), taken (words), served.

    All copies of all documents are returned, those beyond the budget with taken = 0.  `row` numbers
    the rows of `docs`.
    """
    sizes = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    sizes = staged(sizes.withColumn("row", F.monotonically_increasing_id()), "mixing-sizes")
    targets = source_targets(sizes, share, weights, copies).withColumn("goal", F.round("target").cast("long"))
    targets = staged(targets.coalesce(1), "mixing-targets")
    facts = targets.agg(F.count("*").alias("sources"), F.sum("rows").alias("rows"), F.sum("goal").alias("budget")).first()
    if facts["sources"] <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    same_source = F.col("d.source").eqNullSafe(F.col("t.source"))
    offered = (
        sizes.withColumn("copy", F.explode(F.array(*[F.lit(i) for i in range(copies)])))
        .withColumn("key", shuffle_key(F.col("doc_id"), F.col("copy"), seed))
        .alias("d")
        .join(targets.alias("t"), same_source)
        .select("row", "doc_id", "d.source", "copy", "size", "key", "rows", "source_size", "target", "goal")
        .withColumn("slots", F.ceil(F.col("rows") / F.lit(slot_rows)))
        .withColumn(
            "slot",
            F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(2.0**32) * F.col("slots")),
        )
    )
    slot_sums = offered.groupBy("source", "copy", "slot").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("copy", "slot").rowsBetween(Window.unboundedPreceding, -1)
    slot_sums = slot_sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    in_slot = (
        Window.partitionBy("source", "copy", "slot")
        .orderBy("key", "doc_id", "size", "row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    given = offered.withColumn("within", F.sum("size").over(in_slot)).alias("o").join(
        slot_sums.alias("s"),
        F.col("o.source").eqNullSafe(F.col("s.source"))
        & (F.col("o.copy") == F.col("s.copy"))
        & (F.col("o.slot") == F.col("s.slot")),
    )
    end = F.col("before") + F.col("within")
    timed = given.select("row", "doc_id", "o.source", "o.copy", "size", "source_size", "target", "goal", end.alias("end"))
    # A document that runs over the goal is offered up to it; its rest would come after time 1.
    over = (F.col("end") > F.col("goal")) & (F.col("end") - F.col("size") < F.col("goal"))
    words = F.when(over, F.col("goal") - F.col("end") + F.col("size")).otherwise(F.col("size"))
    time = F.when(over, F.lit(1.0)).when(F.col("goal") > 0, F.col("end") / F.col("goal")).otherwise(F.lit(0.0))
    served = _serve(
        timed.withColumn("words", words).withColumn("finish", time), int(facts["budget"] or 0),
        max(1, copies * int(facts["rows"] or 0) // range_rows),
    )
    part = F.col("given")
    taken = F.when(part * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0)) if whole else part
    # An empty document is served if it is offered before time 1.
    offered_in_time = F.col("end") - F.col("size") < F.col("goal")
    return served.select(
        "row", "doc_id", "source", "copy", "size", "source_size", "target", "finish", taken.cast("long").alias("taken"),
        (offered_in_time & ((F.col("size") == 0) | (taken > 0))).alias("served"),
    )


def _serve(queue: DataFrame, budget: int, ranges: int) -> DataFrame:
    """The queue with `given`: how many of its `words` each entry gives until the budget is used up.

    The queue is range-sorted by finish time; an entry's running total is the sum of
    the ranges before its own, and of what precedes it in its range.
    """
    order = ["finish", "doc_id", "copy", "row"]
    queue = queue.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id())
    queue = staged(queue, "mixing-queue")
    sums = queue.groupBy("range").agg(F.sum("words").alias("held"))
    # One row per range.
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("range", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("earlier"))
    in_range = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.col("earlier") + F.col("upto")
    left = F.lit(budget) - (total - F.col("words"))
    return (
        queue.withColumn("upto", F.sum("words").over(in_range))
        .join(sums, "range")
        .withColumn("given", F.greatest(F.lit(0), F.least(F.col("words"), left)))
    )


def mixture(docs: DataFrame, seed: int = 7, **options) -> DataFrame:
    """The documents of the mix, whole, as often as they are taken, in the order they are served.

    Rows keep the columns of `docs`; they are range-sorted by virtual finish time.
    """
    served = fair_queue(docs, seed, whole=True, **options).where("served")
    order = served.select(
        F.col("doc_id").alias("__doc"), F.col("source").alias("__source"),
        F.col("finish").alias("__finish"), F.col("copy").alias("__copy"),
    ).dropDuplicates(["__doc", "__source", "__copy"])
    rows = docs.join(
        order,
        docs["doc_id"].eqNullSafe(F.col("__doc")) & docs["source"].eqNullSafe(F.col("__source")),
    )
    return rows.sort("__finish", "__doc", "__copy").select(*[docs[f"`{c}`"] for c in docs.columns])


def mixed_amounts(docs: DataFrame, seed: int = 7, **options) -> DataFrame:
    """Per row of `docs`: doc_id, source, size, source_size, target, taken over all copies."""
    return (
        fair_queue(docs, seed, **options)
        .groupBy("row", "doc_id", "source", "size", "source_size", "target")
        .agg(F.sum("taken").alias("taken"))
        .drop("row")
    )
