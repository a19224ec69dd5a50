"""Mixing sources to target weights by weighted fair queueing.

Every document of a source stands in that source's shuffled queue; a copy's
virtual finish time is the source's cumulative tokens (earlier epochs included)
divided by the source's target.  All queues are served in the order of finish
time and the service is cut at the total budget.

Queues and service order are prefix sums over range buckets: the sums of a
fixed number of buckets are added up first and only the rows inside a bucket
are sorted, so neither a source with most rows nor the whole order meets in
one task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertlens.llm.common import hex_bucket, id_hash, materialize, renamed, restored, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
TIME_BUCKETS = 4096
_UP_TO = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def source_targets(rows: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(m_source, m_total, m_target, m_budget) of rows (m_source, m_size).

    The budget is the sum of all sizes.  Sources in code point order, null
    last, take the weights in turn.  Targets share the budget by weight; one
    that passes max_repeats times its source stops there and the excess is
    shared again by weight, which is a water level over the ratio cap / weight.
    """
    totals = rows.groupBy("m_source").agg(F.sum("m_size").alias("m_total"))
    turn = F.row_number().over(Window.orderBy(F.col("m_source").asc_nulls_last())) - 1
    level = Window.orderBy("m_ratio", "m_turn")
    everything = Window.partitionBy()
    shared = (
        totals.withColumn("m_turn", turn)
        .withColumn("m_weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("m_turn") % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("m_cap", F.col("m_total") * max_repeats)
        .withColumn("m_ratio", F.col("m_cap").cast("double") / F.col("m_weight"))
        .withColumn("m_budget", F.sum("m_total").over(everything))
        .withColumn("m_rest", F.col("m_budget") - F.coalesce(F.sum("m_cap").over(level.rowsBetween(*_BEFORE)), F.lit(0)))
        .withColumn("m_open", F.sum("m_weight").over(everything) - F.coalesce(F.sum("m_weight").over(level.rowsBetween(*_BEFORE)), F.lit(0)))
        .withColumn("m_level", F.col("m_rest").cast("double") / F.col("m_open"))
        .withColumn("m_place", F.row_number().over(level))
    )
    first = F.min(F.when(F.col("m_level") <= F.col("m_ratio"), F.struct("m_place", "m_level"))).over(everything)
    target = F.least(first["m_level"] * F.col("m_weight"), F.col("m_cap").cast("double"))
    return shared.select("m_source", "m_total", target.alias("m_target"), "m_budget")


def mix(docs: DataFrame, size: Column | None = None, weights=WEIGHTS,
        max_repeats: int = MAX_REPEATS, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, times, taken.

    `size` defaults to the number of words of the text; `keep` names further
    narrow input columns to carry along.  times is the number of copies served and
    taken = times * size.

    Null text: size 0, times 0.  Null source: a source of its own, last in
    order.  Null or repeated doc_id: each row is a document of its own; equal
    rows tie and share their turn in any order.  Empty input: no rows.  A very
    long text counts whole and is served only if it ends within the budget.
    Columns of the input that are not named are not read.
    """
    named = word_count(F.col("text")) if size is None else size.cast("long")
    rows = docs.select(
        F.col("doc_id").alias("m_id"), F.col("source").alias("m_source"), named.alias("m_size"),
        id_hash(F.col("doc_id")).alias("m_key"), *[F.col(c).alias(f"k_{c}") for c in keep],
    ).withColumn("m_bucket", hex_bucket(F.col("m_key"), 3))
    rows = materialize(rows)  # narrow, so that words are counted once
    kept = [f"k_{c}" for c in keep]

    targets = source_targets(rows, weights, max_repeats)
    starts = (
        rows.groupBy("m_source", "m_bucket").agg(F.sum("m_size").alias("m_sum"))
        .withColumn("m_start", F.coalesce(F.sum("m_sum").over(Window.partitionBy("m_source").orderBy("m_bucket").rowsBetween(*_BEFORE)), F.lit(0)))
    )
    t, s = targets.alias("t"), starts.alias("s")
    offsets = t.join(s, F.col("t.m_source").eqNullSafe(F.col("s.m_source"))).select(
        F.col("t.m_source").alias("o_source"), F.col("s.m_bucket").alias("o_bucket"), "m_start", "m_total", "m_target", "m_budget")
    queue = Window.partitionBy("m_source", "m_bucket").orderBy("m_key", "m_id", "m_size").rowsBetween(*_UP_TO)
    queued = (
        rows.join(offsets, F.col("m_source").eqNullSafe(F.col("o_source")) & (F.col("m_bucket") == F.col("o_bucket")))
        .withColumn("m_end", F.col("m_start") + F.sum("m_size").over(queue))
    )

    def finish(epoch) -> Column:
        # a source without words has no target and nothing to serve
        return F.try_divide((epoch * F.col("m_total") + F.col("m_end")).cast("double"), F.col("m_target"))

    def slot(epoch) -> Column:
        return F.least(F.floor(finish(epoch) * TIME_BUCKETS), F.lit(2 * TIME_BUCKETS)).cast("int")

    epochs = list(range(max_repeats))
    queued = queued.withColumn("m_slots", F.array(*[slot(F.lit(e)) for e in epochs]))
    served = queued.filter(F.col("m_size") > 0)
    by_time = (
        served.select(F.explode("m_slots").alias("m_slot"), "m_size", "m_budget")
        .groupBy("m_slot").agg(F.sum("m_size").alias("m_sum"), F.max("m_budget").alias("m_budget"))
        .withColumn("m_through", F.sum("m_sum").over(Window.orderBy("m_slot").rowsBetween(*_UP_TO)))
        .filter(F.col("m_through") > F.col("m_budget"))
        .agg(F.min(F.struct("m_slot", (F.col("m_through") - F.col("m_sum")).alias("m_before"))).alias("m_cut"))
    )
    cut = by_time.first()["m_cut"]  # one row: the time bucket in which the budget runs out
    edge, before = (cut["m_slot"], cut["m_before"]) if cut else (2 * TIME_BUCKETS + 1, 0)

    full = sum((F.col("m_slots")[e] < edge).cast("long") for e in epochs)
    on_edge = F.array_contains("m_slots", F.lit(edge)) & (F.col("m_size") > 0)
    clear = queued.filter(~on_edge).withColumn("m_times", F.when(F.col("m_size") > 0, full).otherwise(0))
    order = Window.partitionBy("m_slot").orderBy("m_time", F.col("m_source").asc_nulls_last(), "m_key", "m_id", "m_size", "m_epoch").rowsBetween(*_UP_TO)
    same = ["m_id", "m_source", "m_size", "m_total", "m_target", "m_budget", "m_end"]
    edge_rows = (
        queued.filter(on_edge).withColumn("m_full", full)
        .select("*", F.explode(F.array(*map(F.lit, epochs))).alias("m_epoch"))
        .withColumn("m_slot", F.col("m_slots")[F.col("m_epoch")]).filter(F.col("m_slot") == edge)
        .withColumn("m_time", finish(F.col("m_epoch")))
        .withColumn("m_taken", (F.lit(before) + F.sum("m_size").over(order) <= F.col("m_budget")).cast("long"))
        # (source, end) names a row of the queue: sizes are positive here
        .groupBy(*same).agg((F.max("m_full") + F.sum("m_taken")).alias("m_times"), *[F.first(c).alias(c) for c in kept])
    )
    cols = [*same, "m_times", *kept]
    return clear.select(cols).unionByName(edge_rows.select(cols)).select(
        F.col("m_id").alias("doc_id"), F.col("m_source").alias("source"), F.col("m_size").alias("size"),
        F.col("m_total").alias("source_size"), F.col("m_target").alias("target"),
        F.col("m_times").cast("long").alias("times"), (F.col("m_times") * F.col("m_size")).alias("taken"),
        *[F.col(f"k_{c}").alias(c) for c in keep if c not in ("doc_id", "source")])


def mixed(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The rows of documents as often as the mix serves them, none for 0.

    Rows that repeat an id and text each come the rounded-up mean of their
    numbers of times.  Other columns may have any names.
    """
    row = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("m_hash"))
    served = (mix(row, weights=weights, max_repeats=max_repeats, keep=("m_hash",))
              .groupBy(F.col("doc_id").alias("m_id"), "m_hash").agg(F.ceil(F.avg("times")).cast("int").alias("m_times")).filter("m_times > 0"))
    rows, names = renamed(docs, "doc_id", "text")
    joined = rows.join(served, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.xxhash64("text") == F.col("m_hash")))
    copies = joined.select(*names.values(), F.explode(F.sequence(F.lit(1), F.col("m_times"))).alias("m_copy"))
    return copies.select(*restored(names))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS total FROM d GROUP BY source),
w AS (SELECT source, total, 3 * total AS cap,
             [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)] AS weight,
             row_number() OVER (ORDER BY source NULLS LAST) AS turn FROM s),
r AS (SELECT *, CAST(cap AS DOUBLE) / weight AS ratio, (sum(total) OVER ())::BIGINT AS budget FROM w),
l AS (SELECT *,
        CAST((budget - coalesce(sum(cap) OVER (ORDER BY ratio, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS DOUBLE)
          / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY ratio, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev,
        row_number() OVER (ORDER BY ratio, turn) AS place FROM r),
t AS (SELECT source, total, budget,
        least((SELECT lev FROM l WHERE lev <= ratio ORDER BY place LIMIT 1) * weight, CAST(cap AS DOUBLE)) AS target FROM l),
q AS (SELECT d.doc_id, d.source, d.size, d.k, t.total, t.target, t.budget,
        (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING))::BIGINT AS fin
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT q.*, e, CAST(e * total + fin AS DOUBLE) / target AS vt FROM q, (SELECT unnest([0, 1, 2]) AS e) WHERE size > 0),
o AS (SELECT doc_id, fin, source, size,
        sum(size) OVER (ORDER BY vt, source NULLS LAST, k, doc_id, size, e ROWS UNBOUNDED PRECEDING) <= budget AS took FROM c),
n AS (SELECT doc_id, fin, source, count(*) FILTER (took) AS times FROM o GROUP BY ALL)
SELECT q.doc_id, q.size, q.total AS source_size, q.target, coalesce(n.times, 0)::BIGINT * q.size AS taken
FROM q LEFT JOIN n ON q.doc_id IS NOT DISTINCT FROM n.doc_id AND q.fin = n.fin AND q.source IS NOT DISTINCT FROM n.source AND q.size > 0
"""
