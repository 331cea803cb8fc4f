"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows are dealt by hash into parts. Given the parts' exact row counts, the number of rows that
each part sends to each shard is drawn from the multivariate hypergeometric law, by halving the
list of parts again and again. A part is permuted locally and cut by its row of the matrix; the
rows are exchanged and permuted again inside blocks of their shard. Row counts of shards differ
by at most one. All of it is DataFrame and SQL functions; every choice is a hash of the seed and
of the row's id and text, so a task that is run again gives the same rows.

Defined results: NULL texts and empty texts are rows like any other; rows with a NULL or repeated
id each get a slot of their own (which of rows with one id and text gets which is not fixed); an empty table gives
no rows. Input columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldcast.llm.scratch import aside, kept

PART_ROWS = 50_000
#: Standard deviations kept on either side of a draw's mean; what lies beyond has a chance
#: below 1e-30.
SPREAD = 12


def _uniform(*parts: str) -> str:
    """SQL for a number in (0, 1) fixed by ``parts``."""
    return f"((pmod(xxhash64({', '.join(parts)}), 4503599627370496) + 0.5D) / 4503599627370496D)"


def _draw(pool: str, good: str, drawn: str, uniform: str) -> str:
    """SQL for a hypergeometric number: how many of ``drawn`` out of ``pool`` are ``good``.

    Inversion over the ratios of neighbouring probabilities: a first pass sums the unscaled
    probabilities, a second stops where the running sum passes the uniform number's share.
    """
    mean = f"({drawn} * ({good} / {pool}))"
    wide = (f"({SPREAD} * sqrt(greatest(0D, {mean} * (1 - {good} / {pool})"
            f" * (({pool} - {drawn}) / greatest({pool} - 1, 1)))) + 20)")
    low = f"cast(greatest(0D, {drawn} - ({pool} - {good}), floor({mean} - {wide})) as bigint)"
    high = f"cast(least({drawn}, {good}, ceil({mean} + {wide})) as bigint)"
    ratio = ("(cast(v.good - k as double) * (v.drawn - k)"
             " / (cast(k + 1 as double) * (v.pool - v.good - v.drawn + k + 1)))")
    # k runs over low .. high - 1; each step goes from k to k + 1
    steps = "slice(sequence(v.low, v.high), 1, cast(v.high - v.low as int))"
    total = (f"aggregate({steps}, named_struct('p', 1D, 's', 1D),"
             f" (a, k) -> named_struct('p', a.p * {ratio}, 's', a.s + a.p * {ratio}), a -> a.s)")
    found = (f"aggregate({steps}, named_struct('p', 1D, 's', 1D, 'k', w.low),"
             f" (a, k) -> if(a.s > w.goal, a, named_struct('p', a.p * {ratio.replace('v.', 'w.')},"
             f" 's', a.s + a.p * {ratio.replace('v.', 'w.')}, 'k', k + 1)), a -> a.k)"
             ).replace("v.", "w.")
    inner = (f"transform(array(named_struct('good', v.good, 'pool', v.pool, 'drawn', v.drawn,"
             f" 'low', v.low, 'high', v.high, 'goal', v.u * {total})), w -> {found})[0]")
    given = (f"named_struct('good', {good}, 'pool', {pool}, 'drawn', {drawn}, 'low', {low},"
             f" 'high', {high}, 'u', {uniform})")
    return (f"if({good} = 0 or {drawn} = 0, 0L,"
            f" if({pool} = {good}, {drawn}, transform(array({given}), v -> {inner})[0]))")


def split_counts(drawn: str, room: str, seed: str) -> Column:
    """Draw, shard by shard, how many of ``drawn`` rows go to shards with ``room`` places left."""
    k = _draw("acc.pool", "c", "acc.rest", _uniform(seed, "size(acc.took)"))
    step = f"""
      transform(array(named_struct('acc', acc, 'c', c, 'k', {k})), s -> named_struct(
        'rest', s.acc.rest - s.k, 'pool', s.acc.pool - s.c,
        'took', concat(s.acc.took, array(s.k))))[0]"""
    return F.expr(f"""
      aggregate({room},
        named_struct('rest', {drawn}, 'pool', aggregate({room}, 0L, (x, y) -> x + y),
                     'took', cast(array() as array<bigint>)),
        (acc, c) -> {step}, acc -> acc.took)""")


def matrix(counts: DataFrame, parts: int, shards: int, seed: int) -> DataFrame:
    """Per part: how many rows go to each shard (``sends``).

    ``counts`` has ``part`` (0 to ``parts`` - 1, none missing) and ``n``; ``parts`` is a power of 2. A node of the tree
    holds a run of parts and the places left for it; its left half draws its share.
    """
    whole = counts.agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("p")).select(
        F.lit(0).cast("long").alias("node"), F.expr("transform(p, x -> x.n)").alias("ns"))
    sized = whole.withColumn("rows", F.expr("aggregate(ns, 0L, (x, y) -> x + y)"))
    level = sized.select(
        "node", "ns",
        F.expr(f"transform(sequence(0, {shards - 1}), s -> "
               f"rows div {shards} + if(s < rows % {shards}, 1L, 0L))").alias("room"))
    for depth in range(int(math.log2(parts))):
        width = parts >> (depth + 1)
        drawn = level.withColumn("left_n", F.expr(
            f"aggregate(slice(ns, 1, {width}), 0L, (x, y) -> x + y)"))
        drawn = drawn.withColumn("left", split_counts(
            "left_n", "room", f"{seed}L, {depth}, node"))
        level = drawn.select(F.explode(F.expr(f"""array(
            named_struct('node', node * 2, 'ns', slice(ns, 1, {width}), 'room', left),
            named_struct('node', node * 2 + 1, 'ns', slice(ns, {width + 1}, {width}),
                         'room', zip_with(room, left, (x, y) -> x - y)))""")).alias("n"))
        level = level.select("n.*")
        if depth == 5:
            level = level.repartition("node")  # the other levels are drawn by many tasks
    return level.select(F.col("node").alias("part"), F.col("room").alias("sends"))


def _marked(rows: DataFrame) -> DataFrame:
    """``rows`` with the number that deals them: of id and text, so that rows without an id, or
    with one id, lie apart."""
    return rows.withColumn("_mark", F.xxhash64(*[c for c in ("doc_id", "text") if c in rows.columns]))


def shard(docs: DataFrame, shards: int, seed: int = 7) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in the shard)."""
    spark = docs.sparkSession
    rows, back = aside(docs.drop("shard", "slot"), ["doc_id", "text"])
    rows = _marked(rows)
    total = rows.count()
    parts = 1 << max(0, math.ceil(math.log2(max(1, total / PART_ROWS))))
    blocks = max(1, math.ceil(total / shards / PART_ROWS))

    def key(salt: int) -> Column:
        return F.xxhash64(F.lit(seed), F.lit(salt), F.col("_mark"))

    def dealt(df: DataFrame, table: DataFrame) -> DataFrame:
        """Local permutation, cut by the matrix. The matrix is keyed by part like the rows."""
        local = Window.partitionBy("_part").orderBy("_first", "doc_id", "_mark")
        placed = df.withColumns({"_part": F.pmod(key(1), F.lit(parts)), "_first": key(2)})
        placed = placed.withColumn("_rank", F.row_number().over(local))
        return placed.join(table, "_part").withColumn(
            "shard", F.size(F.expr("filter(_ends, e -> e < _rank)"))
        ).withColumn("_block", F.pmod(key(3), F.lit(blocks)))

    counted = rows.groupBy(F.pmod(key(1), F.lit(parts)).alias("part")).agg(
        F.count(F.lit(1)).alias("n"))
    counts = spark.range(parts).select(F.col("id").alias("part")).join(counted, "part", "left")
    counts = counts.select("part", F.coalesce("n", F.lit(0)).alias("n"))
    table = kept(matrix(counts, parts, shards, seed).select(
        F.col("part").alias("_part"),
        F.expr("transform(sequence(1, size(sends)), i -> "
               "aggregate(slice(sends, 1, i), 0L, (x, y) -> x + y))").alias("_ends")),
        "shard-matrix")
    # sizes of the blocks in which the second permutation is made, from ids alone
    sizes = dealt(rows.select("doc_id", "_mark"), table).groupBy("shard", "_block").agg(
        F.count(F.lit(1)).alias("n"))
    starts = kept(sizes.select("shard", "_block", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start")), "shard-blocks")
    again = Window.partitionBy("shard", "_block").orderBy(key(4), "doc_id", "_mark")
    sent = dealt(rows, table).drop("_part", "_first", "_rank", "_ends")
    return back(
        sent.withColumn("_place", F.row_number().over(again))
        .join(starts, ["shard", "_block"])
        .withColumn("slot", (F.col("_start") + F.col("_place") - 1).cast("long")),
        "shard", "slot")
