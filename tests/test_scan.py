"""Scan primitive: equals numpy cumsum for any block count; layout invariance; hot values."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from hazardflow.operators.scan import block_of, bucketed_lead, prefix_scan, value_edges


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=60), st.integers(1, 12))
def test_prefix_scan_matches_cumsum(spark, times, blocks):
    pdf = pd.DataFrame({"t": np.array(times, dtype=float)}).groupby("t").size().rename("n").reset_index()
    df = spark.createDataFrame(pdf)
    got = prefix_scan(df, [], "t", {"ge": "n"}, descending=True, n_blocks=blocks).toPandas()
    got = got.sort_values("t")
    expect = pdf.sort_values("t", ascending=False)["n"].cumsum()[::-1].to_numpy()
    assert got["ge"].tolist() == expect.tolist()


def test_grouped_scan_with_hot_value_and_partitions(spark):
    rng = np.random.default_rng(3)
    t = rng.integers(0, 50, 900).astype(float)
    t[:300] = 17.0
    g = rng.choice(["a", "b", "c"], 900)
    pdf = pd.DataFrame({"g": g, "t": t}).groupby(["g", "t"]).size().rename("n").reset_index()
    expect = pdf.sort_values(["g", "t"]).groupby("g")["n"].cumsum().to_numpy()
    for parts in (1, 3, 16):
        df = spark.createDataFrame(pdf).repartition(parts)
        got = prefix_scan(df, ["g"], "t", {"cum": "n"}, n_blocks=5).toPandas().sort_values(["g", "t"])
        assert got["cum"].tolist() == expect.tolist()


def test_min_scan(spark):
    pdf = pd.DataFrame({"k": [1.0, 2.0, 3.0, 4.0], "v": [None, 5.0, None, 2.0]})
    got = prefix_scan(spark.createDataFrame(pdf), [], "k", {"m": "v"}, descending=True,
                      how="min", n_blocks=2).toPandas().sort_values("k")
    assert got["m"].tolist() == [2.0, 2.0, 2.0, 2.0]


def test_edge_values_are_own_blocks(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 2, 2, 3, 9]], "x double")
    edges = value_edges(df, "x", 3)
    blk = df.select("x", block_of(F.col("x"), edges).alias("b")).toPandas()
    # all copies of one value share a block; an edge value's block holds only that value
    assert blk.groupby("x")["b"].nunique().max() == 1
    for b, grp in blk.groupby("b"):
        if b % 2 == 1:
            assert grp["x"].nunique() == 1


def test_bucketed_lead_matches_window(spark):
    rng = np.random.default_rng(5)
    n = 500
    pdf = pd.DataFrame({"k": rng.integers(0, 4, n), "o": rng.integers(0, 40, n).astype(float),
                        "id": np.arange(n)})
    pdf.loc[:200, "k"] = 0
    got = bucketed_lead(spark.createDataFrame(pdf), ["k"], "o", "id", {"nxt": "id"}, n_blocks=6)
    got = got.toPandas().set_index("id")["nxt"]
    srt = pdf.sort_values(["k", "o", "id"])
    expect = srt.groupby("k")["id"].shift(-1)
    for i, v in expect.items():
        g = got.loc[srt.loc[i, "id"]]
        assert (pd.isna(v) and pd.isna(g)) or v == g
