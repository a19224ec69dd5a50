"""Sharding along a Hilbert curve, in DataFrame functions only.

Each row's metadata are quantised to a grid cell, cells are ordered by their
index on the Hilbert curve through the grid and the order is cut into runs of
equal row counts.  Neighbours on the curve are neighbours in every dimension,
so a run covers a compact box and its files can be skipped by min/max
statistics on any of the dimensions.
"""
from __future__ import annotations

from functools import cache
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertlens.llm.common import checkpointed, hex_bucket, id_hash

BITS = 5
SHARDS = 8
_BEFORE = (Window.unboundedPreceding, -1)


@cache
def automaton(dims: int) -> tuple[list[int], list[int]]:
    """The curve as a state machine: (next state, output digit) at state * 2^dims + octant.

    Octants of a cell are visited in the order of the reflected Gray code,
    turned so that it begins at the corner `entry` and leaves along the axis
    `along`; (entry, along) is the state.
    """
    fan = 1 << dims

    def left(x: int, by: int) -> int:
        by %= dims
        return ((x << by) | (x >> (dims - by))) & (fan - 1)

    gray = [i ^ (i >> 1) for i in range(fan)]
    place = {g: i for i, g in enumerate(gray)}
    first = [0, *(gray[2 * ((i - 1) // 2)] for i in range(1, fan))]
    ones = [next(k for k in range(dims + 2) if not i >> k & 1) for i in range(fan)]
    axis = [0, *(ones[i if i % 2 else i - 1] % dims for i in range(1, fan))]
    moves, digits = [], []
    for entry, along, octant in product(range(fan), range(dims), range(fan)):
        digit = place[left(octant ^ entry, dims - along - 1)]
        digits.append(digit)
        moves.append((entry ^ left(first[digit], along + 1)) * dims + (along + axis[digit] + 1) % dims)
    return moves, digits


def hilbert_column(dims: list[Column], bits: int = BITS) -> Column:
    """Hilbert index of integer columns in [0, 2^bits)."""
    moves, digits = automaton(len(dims))
    fan = 1 << len(dims)
    to, out = F.array(*map(F.lit, moves)), F.array(*map(F.lit, digits))

    def step(acc: Column, bit: Column) -> Column:
        octant = F.lit(0)
        for d in dims:
            octant = octant * 2 + d.bitwiseAND(bit).cast("boolean").cast("int")
        at = acc["state"] * fan + octant + 1
        return F.struct(F.element_at(to, at).alias("state"), (acc["index"] * fan + F.element_at(out, at)).alias("index"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0).alias("index"))
    down = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(down, start, step)["index"]


def value_cells(rows: DataFrame, col: str, bits: int) -> DataFrame:
    """(value, cell): distinct values in order, spread over the grid; null is the last."""
    whole = Window.partitionBy()
    return (rows.select(F.col(col).alias("value")).distinct()
            .withColumn("place", F.row_number().over(Window.orderBy(F.col("value").asc_nulls_last())) - 1)
            .withColumn("cell", F.floor(F.col("place") * (1 << bits) / F.greatest(F.count(F.lit(1)).over(whole), F.lit(1 << bits))).cast("int"))
            .select("value", "cell"))


def shard(docs: DataFrame, n_shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, curve, shard, slot for every row of documents.

    Dimensions: language and source (place among their distinct values) and
    the binary logarithm of the size.  The law is `rows`: the shards' row
    counts are at most one apart.  Ties on the curve go by the md5 of the id.

    Null text: size 1, crc32 of nothing.  Null language or source: the last
    value of its dimension.  Null or repeated ids: every row has a slot of its
    own, equal rows in any order.  Fewer rows than shards: some shards stay
    empty.  Empty input: no rows.  Other input columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = checkpointed(docs.select(
        F.col("doc_id").alias("h_id"), F.col("lang").alias("h_lang"), F.col("source").alias("h_source"),
        (F.octet_length(text) + 1).cast("long").alias("h_size"), F.crc32(F.encode(text, "UTF-8")).alias("h_crc"),
    ))
    length = F.least(F.floor(F.log2(F.col("h_size"))), F.lit((1 << bits) - 1)).cast("int")
    for col in ("h_lang", "h_source"):
        cells = value_cells(rows, col, bits).withColumnRenamed("value", f"{col}_value").withColumnRenamed("cell", f"{col}_cell")
        rows = rows.join(cells, F.col(col).eqNullSafe(F.col(f"{col}_value")))
    placed = (
        rows.withColumn("h_length", length)
        .withColumn("curve", hilbert_column([F.col("h_lang_cell"), F.col("h_source_cell"), F.col("h_length")], bits))
        .withColumn("h_key", id_hash(F.col("h_id")))
        .withColumn("h_part", hex_bucket(F.col("h_key"), 3))
        .select("h_id", "h_size", "h_crc", "curve", "h_key", "h_part")
        .checkpoint()
    )
    # ranks from the outside in: cells of the curve, parts of a cell, rows of a part
    parts = placed.groupBy("curve", "h_part").agg(F.count(F.lit(1)).alias("n"))
    cells = parts.groupBy("curve").agg(F.sum("n").alias("n"))
    cells = cells.select(
        F.col("curve").alias("c_curve"), F.sum("n").over(Window.partitionBy()).alias("total"),
        F.coalesce(F.sum("n").over(Window.orderBy("curve").rowsBetween(*_BEFORE)), F.lit(0)).alias("c_start"))
    parts = parts.join(cells, F.col("curve") == F.col("c_curve")).select(
        F.col("curve").alias("p_curve"), F.col("h_part").alias("p_part"), "total",
        (F.col("c_start") + F.coalesce(F.sum("n").over(Window.partitionBy("curve").orderBy("h_part").rowsBetween(*_BEFORE)), F.lit(0))).alias("start"))
    inside = Window.partitionBy("curve", "h_part").orderBy("h_key", "h_id", "h_size", "h_crc")
    ranked = (
        placed.join(parts, (F.col("curve") == F.col("p_curve")) & (F.col("h_part") == F.col("p_part")))
        .withColumn("rank", F.col("start") + F.row_number().over(inside) - 1)
        .withColumn("shard", F.expr(f"(rank * {n_shards}) div total").cast("int"))
        .withColumn("slot", F.col("rank") - F.expr(f"(shard * total + {n_shards - 1}) div {n_shards}"))
    )
    return ranked.select(
        F.col("h_id").alias("doc_id"), F.col("h_size").alias("size"), F.col("h_crc").alias("text_crc32"),
        F.col("curve"), F.col("shard"), F.col("slot").cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, bits: int = BITS) -> None:
    """Write the documents below path/shard=N, each file a run of the curve.

    Rows that share an id (or have none) go to one place, as their id is what
    they are found by.  Input columns named curve, shard or slot are written as
    in_curve, in_shard and in_slot.
    """
    placed = shard(docs, n_shards, bits).select(F.col("doc_id").alias("s_id"), "curve", "shard", "slot").dropDuplicates(["s_id"])
    cols = [F.col(f"`{c}`").alias(f"in_{c}" if c in ("curve", "shard", "slot", "s_id") else c) for c in docs.columns]
    (docs.select(cols).join(placed, F.col("doc_id").eqNullSafe(F.col("s_id"))).drop("s_id")
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").mode("errorifexists").parquet(path))


def _crc_table() -> list[int]:
    """Remainders of the bytes by the CRC-32 polynomial, lowest bit first."""
    out = list(range(256))
    for _ in range(8):
        out = [(x >> 1) ^ (0xEDB88320 if x & 1 else 0) for x in out]
    return out


def oracle(bits: int = BITS, n_shards: int = SHARDS) -> str:
    """The same sharding in DuckDB SQL: the state machine unrolled bit by bit, crc32 folded byte by byte."""
    octets = "list_transform(range(0, length(hx) // 2), lambda i: CAST('0x' || substr(hx, CAST(2 * i + 1 AS BIGINT), 2) AS UINTEGER))"
    fold = f"lambda c, x: xor(c >> 8, CAST({_crc_table()}[(xor(c, x) & 255) + 1] AS UINTEGER))"
    crc = f"CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS UINTEGER), {octets}), {fold}), 4294967295) AS BIGINT)"
    moves, digits = automaton(3)
    steps, last = [], "cells"
    for b in reversed(range(bits)):
        octant = f"(((lc >> {b}) & 1) * 4 + ((sc >> {b}) & 1) * 2 + ((zc >> {b}) & 1))"
        steps.append(f"w{b} AS (SELECT * REPLACE ({moves}[state * 8 + {octant} + 1] AS state, "
                     f"idx * 8 + {digits}[state * 8 + {octant} + 1] AS idx) FROM {last})")
        last = f"w{b}"
    spread = f"CAST(floor((row_number() OVER (ORDER BY v NULLS LAST) - 1) * {1 << bits} / greatest(count(*) OVER (), {1 << bits})) AS INTEGER)"
    return f"""
WITH d AS (SELECT doc_id, lang, source, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k, {crc} AS text_crc32
           FROM (SELECT *, hex(encode(coalesce(text, ''))) AS hx FROM documents)),
lv AS (SELECT v, {spread} AS c FROM (SELECT DISTINCT lang AS v FROM d)),
sv AS (SELECT v, {spread} AS c FROM (SELECT DISTINCT source AS v FROM d)),
cells AS (SELECT d.*, lv.c AS lc, sv.c AS sc, least(length(bin(size)) - 1, {(1 << bits) - 1}) AS zc, 0 AS state, 0 AS idx
          FROM d JOIN lv ON d.lang IS NOT DISTINCT FROM lv.v JOIN sv ON d.source IS NOT DISTINCT FROM sv.v),
{", ".join(steps)},
r AS (SELECT *, row_number() OVER (ORDER BY idx, k, doc_id, size) - 1 AS rnk, count(*) OVER () AS n FROM {last}),
s AS (SELECT *, rnk * {n_shards} // n AS shard FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(rnk - (shard * n + {n_shards - 1}) // {n_shards} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s
"""
