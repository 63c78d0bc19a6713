"""Distributed ordered prefix scan: the primitive behind risk sets, survival products and leads.

A plain ``Window.partitionBy(g).orderBy(t)`` puts a whole group into one task, and with no
``partitionBy`` the whole table. Here the order column is cut into value blocks taken from
``approxQuantile`` edges; every edge value is a block of its own, so a value holding a third of
all rows never shares a task with its neighbours. Each block is scanned by its own window and
gets the running total of the blocks before it from a small per-(group, block) totals table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardflow.session import cut_lineage

BLOCK = "_blk"


def default_blocks(df: DataFrame) -> int:
    """Blocks per scan: about two per shuffle partition, at least 8."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    return max(8, 2 * parts)


def value_edges(df: DataFrame, col: str, n_blocks: int, rel_err: float | None = None) -> list[float]:
    """Sorted distinct quantile edges of ``col`` (one distributed sketch pass, B values back).

    The sketch's error is a quarter of a block, so that many blocks stay about equally large.
    """
    if n_blocks <= 1:
        return []
    rel_err = min(1e-3, 0.25 / n_blocks) if rel_err is None else rel_err
    probs = [i / n_blocks for i in range(1, n_blocks)]
    got = df.approxQuantile(col, probs, rel_err)
    return sorted({float(e) for e in got if e is not None and not math.isnan(e)})


def block_of(col: Column, edges: Sequence[float]) -> Column:
    """Block id, increasing with the value: 2*#(edges < x), plus 1 when x is itself an edge.

    A binary search over one array literal: log B steps a row and one small expression for any B.
    """
    if not edges:
        return F.lit(0)
    n = len(edges)
    values = F.split(F.lit(",".join(repr(float(e)) for e in edges)), ",").cast("array<double>")  # folded to a literal
    x = col.cast("double")

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        right = (s["lo"] < s["hi"]) & (F.get(values, mid) < x)
        return F.struct(F.when(right, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(right | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))
    below = F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length())), start, halve, lambda s: s["lo"])
    once = F.array(below)  # bound to a name, so that the search runs once a row
    block = F.get(F.transform(once, lambda b: b * 2 + F.coalesce(F.get(values, b) == x, F.lit(False)).cast("int")), F.lit(0))
    return F.when(col.isNotNull(), block)


def with_block(df: DataFrame, col: str, edges: Sequence[float], name: str = BLOCK) -> DataFrame:
    """``df`` with the block id of ``col`` (see ``block_of``): NULL for NULL, NaN in a block above all others.

    A ``Bucketizer`` finds the place among the edges by binary search on the JVM; an array look-up tells edge values.
    """
    edges = list(edges)
    if not edges:
        return df.withColumn(name, F.when(F.col(col).isNotNull(), F.lit(0)))
    infinite = math.inf
    inner = [e for e in edges if not math.isinf(e)]
    bucket = Bucketizer(splits=[-infinite, *inner, infinite], inputCol="_cut", outputCol="_bucket", handleInvalid="keep") if inner else None
    if bucket is None or len(inner) < len(edges):
        return df.withColumn(name, block_of(F.col(col), edges))
    values = F.split(F.lit(",".join(repr(float(e)) for e in edges)), ",").cast("array<double>")  # folded to a literal
    placed = bucket.transform(df.withColumn("_cut", F.col(col).cast("double")))
    at = F.col("_bucket").cast("int")  # edges at or below the value; past the last one for NaN
    block = 2 * at - F.coalesce((F.get(values, at - 1) == F.col("_cut")).cast("int"), F.lit(0))
    return placed.withColumn(name, F.when(F.col("_cut").isNotNull(), block)).drop("_cut", "_bucket")


def null_safe_join(df: DataFrame, other: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``on`` in which NULL keys match each other; ``other`` adds its remaining columns."""
    renamed = other.select(*[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in other.columns if c not in on])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    joined = df.join(renamed, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_on_{c}" for c in on])


def _offset_join(df: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    # The totals table has (#groups x #blocks) rows. Without groups that is the block count, and
    # it is broadcast; otherwise AQE decides from the measured size at run time.
    return null_safe_join(df, offsets if keys else F.broadcast(offsets), [*keys, BLOCK])


_AGG = {"sum": F.sum, "min": F.min, "max": F.max}


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    sums: Mapping[str, Column | str],
    *,
    descending: bool = False,
    n_blocks: int | None = None,
    edges: Sequence[float] | None = None,
    how: str = "sum",
) -> DataFrame:
    """Add inclusive running aggregates (``sum``, ``min`` or ``max``) over ``order_col`` within ``keys``.

    Rows with equal (keys, order value) are combined together (RANGE frame), so the result is
    deterministic; inputs here are normally one row per (keys, order value). A descending scan
    gives suffix sums (risk sets) as prefix sums, never a ``rowsBetween(0, unboundedFollowing)``.
    """
    keys = list(keys)
    agg = _AGG[how]
    if edges is None:
        edges = value_edges(df, order_col, n_blocks or default_blocks(df))
    exprs = {k: (F.col(v) if isinstance(v, str) else v) for k, v in sums.items()}
    tmp = {k: f"_inc_{k}" for k in exprs}
    base = with_block(df, order_col, edges)
    base = base.select("*", *[e.alias(tmp[k]) for k, e in exprs.items()])

    blk_order = F.col(BLOCK).desc() if descending else F.col(BLOCK).asc()
    totals = base.groupBy(*keys, BLOCK).agg(*[agg(tmp[k]).alias(tmp[k]) for k in exprs])
    wb = (Window.partitionBy(*keys).orderBy(blk_order)
          .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*keys, BLOCK, *[agg(tmp[k]).over(wb).alias(f"_off_{k}") for k in exprs])
    joined = _offset_join(base, offsets, keys)
    ordering = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w = (Window.partitionBy(*keys, BLOCK).orderBy(ordering)
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))

    def combine(k):
        inside, before = agg(tmp[k]).over(w), F.col(f"_off_{k}")
        if how == "sum":
            return inside + F.coalesce(before, F.lit(0))
        return F.least(inside, before) if how == "min" else F.greatest(inside, before)

    return joined.select(*df.columns, *[combine(k).alias(k) for k in exprs])


#: A key with more rows is scanned in blocks; the window of any other key holds this many rows at most.
KEY_ROWS = 100_000


def bucketed_lead(
    df: DataFrame,
    keys: Sequence[str],
    order_num: str,
    tiebreak: str,
    values: Mapping[str, str],
    *,
    n_blocks: int | None = None,
    key_rows: int | None = None,
) -> DataFrame:
    """``lead(value) over (partition by keys order by order_num, tiebreak)`` without one large task per key.

    Keys of at most ``key_rows`` counted rows take the plain window; the rows of larger ones are cut into
    value blocks. Both give the same rows.
    """
    keys = list(keys)
    limit = KEY_ROWS if key_rows is None else key_rows
    large = cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).select(*keys))
    plain = Window.partitionBy(*keys).orderBy(F.col(order_num), F.col(tiebreak))

    def simple(rows: DataFrame) -> DataFrame:
        return rows.select("*", *[F.lead(src).over(plain).alias(out) for out, src in values.items()])

    if large.isEmpty():
        return simple(df)
    rest = null_safe_join(df, large, keys, "left_anti")
    return simple(rest).unionByName(_blocked_lead(null_safe_join(df, large, keys, "left_semi"), keys, order_num, tiebreak, values, n_blocks))


def _blocked_lead(df: DataFrame, keys: Sequence[str], order_num: str, tiebreak: str, values: Mapping[str, str],
                  n_blocks: int | None) -> DataFrame:
    """Leads inside (key, value block); the last row of a block takes the first row of the key's next block."""
    edges = value_edges(df, order_num, n_blocks or default_blocks(df))
    base = with_block(df, order_num, edges)
    w = Window.partitionBy(*keys, BLOCK).orderBy(F.col(order_num), F.col(tiebreak))
    first = F.min(F.struct(F.col(order_num).alias("o"), F.col(tiebreak).alias("t"),
                           *[F.col(src).alias(f"v{i}") for i, src in enumerate(values.values())]))
    summary = base.groupBy(*keys, BLOCK).agg(first.alias("_first"))
    ws = Window.partitionBy(*keys).orderBy(BLOCK)
    nxt = summary.select(*keys, BLOCK, F.lead("_first").over(ws).alias("_next_blk"))
    inner = base.select(
        "*", *[F.lead(src).over(w).alias(f"_in_{out}") for out, src in values.items()],
        F.lead(F.lit(1)).over(w).isNotNull().alias("_has_in"),
    )
    joined = null_safe_join(inner, nxt, [*keys, BLOCK])
    return joined.select(
        *df.columns,
        *[F.when(F.col("_has_in"), F.col(f"_in_{out}"))
          .otherwise(F.col(f"_next_blk.v{i}")).alias(out)
          for i, out in enumerate(values)],
    )
