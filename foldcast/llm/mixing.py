"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a fixed pseudo-random order, followed by the same
documents again, up to ``most`` times. A document's virtual finish time is its source's running
word count divided by the source's target. All queues are range-sorted by that time and cut at
the total budget. Everything is DataFrame work on narrow rows; texts are not shuffled.

Defined results: a NULL text has size 0; documents of size 0 take nothing; a NULL source is a
source of its own and comes last; repeated rows queue one after the other; an empty table gives
an empty mix. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldcast.llm.scratch import aside, kept, running_totals

WORD = r"[^\x20\x09-\x0D]+"
SLICE_ROWS = 50_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def target_sizes(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """``source``, ``source_size``, ``rows`` with ``target``: water-filling in closed form.

    A source is full at ``most`` times its size. In the order of room by weight, a source is
    full exactly if the level reached with all sources before it full would overfill it.
    """
    ranked = running_totals(sizes, [F.col("source")], {"place": F.lit(1)}, "mix-rank")
    weigh = F.element_at(F.array(*[F.lit(w) for w in weights]),
                         ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    room = most * F.col("source_size")
    levels = kept(running_totals(
        ranked.withColumn("weight", weigh).withColumn("room", room).drop("place"),
        [F.col("room") / F.col("weight"), F.col("source")],
        {"room_upto": F.col("room"), "weight_upto": F.col("weight")}, "mix-level"), "mix-levels")
    total = levels.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, weight = (total[0] or 0) * share, total[1] or 0
    full = (F.lit(budget) - (F.col("room_upto") - F.col("room"))) * F.col("weight") >= (
        F.col("room") * (F.lit(weight) - (F.col("weight_upto") - F.col("weight"))))
    rest = levels.agg(F.sum(F.when(full, F.col("room"))), F.sum(F.when(~full, F.col("weight")))).first()
    open_room, open_weight = budget - (rest[0] or 0), rest[1] or 1
    return levels.select(
        "source", "source_size", "rows",
        F.when(full, F.col("room").cast("double"))
        .otherwise(F.lit(open_room) / F.lit(open_weight) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2,
        seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """Return the mix and its cut points.

    The first table has ``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and
    ``copies`` for each row of ``docs``. The second has, per source, the last place in the
    shuffled order that each round takes; ``apply_mix`` uses it on whole documents.
    """
    rows = kept(docs.select("doc_id", "source", place(seed).alias("u"), word_count().alias("size")),
                "mix-rows")
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = target_sizes(sizes, weights, share, most)
    budget = (targets.agg(F.sum("source_size")).first()[0] or 0) * share

    # a queue is cut into slices of even width in the shuffled order, so that no task gets
    # a whole source; slice starts come from the sums of the slices before
    sliced = (
        _same_source(rows, targets)
        .withColumn("slices", F.ceil(F.col("rows") / SLICE_ROWS))
        .withColumn("slice", F.floor(_fraction("u") * F.col("slices")).cast("long"))
    )
    keys = ["source", "slice"]
    starts = sliced.groupBy(*keys).agg(F.sum("size").alias("sum")).select(
        *keys, F.coalesce(F.sum("sum").over(
            Window.partitionBy("source").orderBy("slice")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    local = Window.partitionBy(*keys).orderBy("u", "doc_id").rowsBetween(
        Window.unboundedPreceding, 0)
    upto = sliced.withColumn("here", F.sum("size").over(local)).alias("a")
    queued = upto.join(
        starts.alias("b"),
        F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.slice") == F.col("b.slice")),
    ).select("a.doc_id", "a.source", "a.u", "a.size", "a.source_size", "a.target",
             (F.col("b.start") + F.col("a.here")).alias("upto"))
    queued = kept(queued, "mix-queued")

    times = queued.where((F.col("size") > 0) & (F.col("target") > 0)).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("round"))
    finish = (F.col("round") * F.col("source_size") + F.col("upto")) / F.col("target")
    order = [F.col("time"), F.col("source"), F.col("u"), F.col("doc_id")]
    sent = running_totals(times.withColumn("time", finish), order, {"sent": F.col("size")},
                          "mix-sent")
    # the cut is one moment, and at that moment one place in the order of ties
    last = sent.where(F.col("sent") <= F.lit(budget)).agg(
        F.max(F.struct("time", F.col("source").isNull(), "source", "u", "doc_id"))).first()[0]
    if last is None:
        taken = F.lit(0)
    else:
        moments = [(F.lit(r) * F.col("source_size") + F.col("upto")) / F.col("target")
                   for r in range(most)]
        key = F.struct(F.col("source").isNull(), F.coalesce("source", F.lit("")), "u",
                       F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))
        cut = F.struct(F.lit(last[1]), F.lit(last[2] or ""), F.lit(last[3]),
                       F.lit(-(1 << 63) if last[4] is None else last[4]).cast("long"))
        taken = sum((F.when((m < last[0]) | ((m == last[0]) & (key <= cut)), 1).otherwise(0)
                     for m in moments), F.lit(0))
    mixed = queued.select(
        "doc_id", "source", "size", "source_size", "target", "u",
        F.when((F.col("size") > 0) & (F.col("target") > 0), taken).otherwise(0).alias("copies"))
    cuts = mixed.groupBy("source").agg(*[
        F.max(F.when(F.col("copies") >= r, F.struct("u", "doc_id"))).alias(f"round{r}")
        for r in range(1, most + 1)])
    return mixed.drop("u"), cuts


def apply_mix(docs: DataFrame, cuts: DataFrame, most: int = 2, seed: str = "mix") -> DataFrame:
    """Whole documents of the mix, each as often as it was taken.

    ``cuts`` has one short row per source; where Spark finds it small it is broadcast by Spark's
    own size check, else the rows are shuffled by source and AQE splits hot ones. Documents
    without a word are not in a mix.
    """
    rows, back = aside(docs, ["doc_id", "text", "source"])
    keyed = rows.withColumn("_u", place(seed)).alias("d")
    at = F.struct(F.col("_u").alias("u"), F.col("doc_id").alias("doc_id"))
    copies = sum((F.when(at <= F.col(f"c.round{r}"), 1).otherwise(0) for r in range(1, most + 1)),
                 F.lit(0))
    joined = keyed.join(cuts.alias("c").withColumnRenamed("source", "_source"),
                        F.col("d.source").eqNullSafe(F.col("_source")))
    return back(
        joined.withColumn("_copies", F.when(word_count("d.text") > 0, copies).otherwise(0))
        .where("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select("d.*"))


def place(seed: str) -> Column:
    """A document's fixed place in the shuffled order: the digest of its id."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _fraction(u: str) -> Column:
    return F.conv(F.substring(u, 1, 8), 16, 10).cast("double") / float(1 << 32)


def _same_source(rows: DataFrame, targets: DataFrame) -> DataFrame:
    t = targets.withColumnRenamed("source", "_source")
    return rows.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
