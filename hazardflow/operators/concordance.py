"""Exact Harrell C-index without a pair join, for one scorer or many at a time (EV-1).

Comparable pair: subject i has the event and j is later (``t_j > t_i``, or ``t_j = t_i`` and j is
censored). Concordant when ``r_i > r_j``, tied risk counts 1/2. Order rows by the key ``(t, censored)``: j is
comparable to event i exactly when ``key_j > key_i``.

Distinct (time, censored, risk) rows get dense positions p by (key, risk) and s by (risk, p). Concordant pairs
are then those with ``p_j > p_i`` and smaller risk: within one key the order by risk rules them out. Positions
form a tree of fan ``FAN``; two rows meet as different children of exactly one node. In each node, rows in the
order of s see how many rows of later children came before them: those have smaller risk, as equal risks
stand in the order of p. Small nodes are one window each; a large node is cut into blocks of s, whose counts
are added from a table of one row a block. No window holds more than ``block_rows`` rows, whatever is tied.

Pairs of equal risk and all comparable pairs follow from running counts over s and p alone. Counts are exact
(decimals of 38 digits). Keys (for instance feature and repeat of a permutation) share one run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardflow.operators.positions import BLOCK_ROWS, running, with_position

FAN = 4
_COUNT = "decimal(38,0)"


def _times(a: Column, b: Column) -> Column:
    """Exact product of two counts."""
    return (a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast(_COUNT)


def _later_smaller(rows: DataFrame, keys: Sequence[str], n: int, block_rows: int) -> DataFrame:
    """(keys, conc): parts of the number of pairs with a later position and a smaller risk."""
    levels = 1
    while FAN ** levels < n:
        levels += 1
    k = "".join(f"`{c}`, " for c in keys)
    steps = ", ".join(f"named_struct('level', {v}, 'step', {FAN ** v}L)" for v in range(levels))
    at = rows.selectExpr(*(f"`{c}`" for c in keys), "p", "s", "cnt", "ev", f"explode(array({steps})) AS l").selectExpr(
        *(f"`{c}`" for c in keys), "s", "cnt", "ev", "l.level AS level", f"p div (l.step * {FAN}) AS node", f"(p div l.step) % {FAN} AS child",
        f"IF(l.step * {FAN} <= {block_rows}, 0L, s div {block_rows}) AS block")
    over = f"OVER (PARTITION BY {k}level, node, block ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    later = " + ".join(f"IF(child < {b}, sum(IF(child = {b}, cnt, 0)) {over}, 0)" for b in range(1, FAN))
    near = at.select(*keys, "ev", F.expr(f"{later} AS seen")).where("ev > 0").select(*keys, _times(F.col("ev"), F.col("seen")).alias("conc"))
    # large nodes: rows of earlier blocks
    totals = at.where(f"power({FAN}, level + 1) > {block_rows}").groupBy(*keys, "level", "node", "block").agg(
        *[F.expr(f"sum(IF(child = {b}, cnt, 0)) AS c{b}") for b in range(1, FAN)],
        *[F.expr(f"sum(IF(child = {a}, ev, 0)) AS e{a}") for a in range(FAN - 1)])
    before = f"OVER (PARTITION BY {k}level, node ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    far = totals.selectExpr("*", *[f"coalesce(sum(c{b}) {before}, 0) AS b{b}" for b in range(1, FAN)])
    number = lambda e: f"CAST({e} AS DECIMAL(19, 0))"
    pairs = " + ".join(f"CAST({number(f'e{a}')} * {number(' + '.join(f'b{b}' for b in range(a + 1, FAN)))} AS DECIMAL(38, 0))"
                       for a in range(FAN - 1))
    return near.unionByName(far.select(*keys, F.expr(f"CAST({pairs} AS DECIMAL(38, 0)) AS conc"))) if FAN ** levels > block_rows else near


def concordance_by(df: DataFrame, keys: Sequence[str] = (), *, time_col: str = "duration", event_col: str = "event",
                   risk_col: str = "risk", n_blocks: int | None = None) -> DataFrame:
    """(keys, comparable, concordant, tied_risk, c_index): one row a key; NULL keys are a key of their own.

    Rows with a missing time, event or risk take no part. Without comparable pairs the index is NaN.
    ``n_blocks`` cuts large nodes into that many blocks; the result doesn't depend on it.
    """
    keys = list(keys)
    t, r = F.col(time_col).cast("double"), F.col(risk_col).cast("double")
    known = df.where(t.isNotNull() & F.col(event_col).isNotNull() & r.isNotNull() & ~F.isnan(t) & ~F.isnan(r))
    rows = known.groupBy(*keys, (t + 0.0).alias("t"), (F.col(event_col) <= 0).cast("int").alias("c"), (r + 0.0).alias("r")).agg(
        F.count(F.lit(1)).alias("cnt")).withColumn("ev", F.when(F.col("c") == 0, F.col("cnt")).otherwise(0))
    rows = with_position(rows, [*keys, "t", "c", "r"], "p")
    rows = with_position(rows, [*keys, "r", "p"], "s")  # checkpointed: what follows reads it, not the input
    n = rows.count()
    block_rows = -(-n // n_blocks) if n_blocks else BLOCK_ROWS
    block_rows = max(block_rows, FAN)
    zero = F.lit(0).cast(_COUNT)
    pairs = _later_smaller(rows, keys, n, block_rows).select(*keys, "conc", zero.alias("tied"), zero.alias("comp"))
    # of a risk's rows, those after row i in s: all up to the risk's last row, less those up to i
    by_s = running(rows, "s", {"upto": "cnt"}, block_rows)
    last = by_s.groupBy(*keys, "r").agg(F.max("upto").alias("last"), F.sum("ev").alias("ev")).select(
        *keys, zero.alias("conc"), _times(F.col("last"), F.col("ev")).alias("tied"), zero.alias("comp"))
    own = by_s.where("ev > 0").select(*keys, zero.alias("conc"), (-_times(F.col("upto"), F.col("ev"))).cast(_COUNT).alias("tied"),
                                      zero.alias("comp"))
    # of a key's rows, those after all events of one time
    by_p = running(rows, "p", {"upto": "cnt"}, block_rows)
    ends = by_p.groupBy(*keys).agg(F.max("upto").alias("last"), F.sum("ev").alias("ev")).select(
        *keys, zero.alias("conc"), zero.alias("tied"), _times(F.col("last"), F.col("ev")).alias("comp"))
    spent = by_p.where("c = 0").groupBy(*keys, "t").agg(F.max("upto").alias("last"), F.sum("ev").alias("ev")).select(
        *keys, zero.alias("conc"), zero.alias("tied"), (-_times(F.col("last"), F.col("ev"))).cast(_COUNT).alias("comp"))
    both = pairs.unionByName(last).unionByName(own).unionByName(ends).unionByName(spent)
    total = both.groupBy(*keys).agg(F.sum("comp").alias("comparable"), F.sum("conc").alias("concordant"),
                                    F.sum("tied").alias("tied_risk"))
    index = F.when(F.col("comparable") > 0, (F.col("concordant").cast("double") + 0.5 * F.col("tied_risk").cast("double"))
                   / F.col("comparable").cast("double")).otherwise(F.lit(float("nan")))
    out = total.withColumn("c_index", index)
    if not keys:
        out = out.select(*[F.coalesce(c, zero).alias(c) for c in ("comparable", "concordant", "tied_risk")],
                         F.coalesce("c_index", F.lit(float("nan"))).alias("c_index"))
    return out


def concordance(df: DataFrame, *, time_col: str = "duration", event_col: str = "event",
                risk_col: str = "risk", n_blocks: int | None = None) -> dict:
    """Harrell's C: ``{c_index, concordant, tied_risk, comparable}`` (exact equality for ties)."""
    r = concordance_by(df, time_col=time_col, event_col=event_col, risk_col=risk_col, n_blocks=n_blocks).first()
    return {"c_index": r["c_index"], **{k: int(r[k]) for k in ("concordant", "tied_risk", "comparable")}}


def concordance_table(df: DataFrame, **kw) -> DataFrame:
    out = concordance_by(df, **kw)
    return out.select(*[F.col(c).cast("double").alias(c) for c in ("comparable", "concordant", "tied_risk", "c_index")])
