"""Exact quantiles, common bins and drift against plain computations."""

from __future__ import annotations

import math

import numpy as np
import pytest

from actionwise.operators import distributions, quantiles


def plain_quantiles(values, parts):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return [kept[(k * len(kept) + parts - 1) // parts - 1] for k in range(1, parts)]


@pytest.mark.parametrize("parts", [2, 20])
def test_quantiles_of_many_columns(spark, parts, monkeypatch):
    monkeypatch.setattr(quantiles, "PARTS", 50)  # many passes
    rng = np.random.default_rng(3)
    n = 700
    columns = {
        "uniform": rng.random(n).tolist(),
        "scales": (rng.choice([-1, 1], n) * 10.0 ** rng.integers(-300, 300, n)).tolist(),
        "narrow": (1 + rng.integers(0, 50, n) * 2.0**-52).tolist(),
        "ties": rng.choice([1.0, 2.0, 2.0, 2.0], n).tolist(),
        "same": [7.0] * n,
        "gaps": [None if k % 3 else (math.nan if k % 2 else float(k)) for k in range(n)],
        "wild": [[math.inf, -math.inf, 0.0, -0.0, 1e308, -1e308, None][k % 7] for k in range(n)],
        "empty": [None] * n,
        "whole": rng.integers(-5, 900, n).tolist(),
    }
    rows = [tuple(c[i] for c in columns.values()) for i in range(n)]
    schema = ", ".join(f"{c} {'long' if c == 'whole' else 'double'}" for c in columns)
    got = quantiles.exact_quantiles(spark.createDataFrame(rows, schema).repartition(5), list(columns), parts).collect()
    found = {}
    for r in sorted(got, key=lambda r: r["k"]):
        found.setdefault(r["column"], []).append(r["value"])
    assert found == {c: plain_quantiles(v, parts) for c, v in columns.items() if c != "empty"}
    assert {r["n"] for r in got if r["column"] == "gaps"} == {sum(v is not None and not math.isnan(v) for v in columns["gaps"])}


def test_quantiles_of_few_rows(spark):
    one = spark.createDataFrame([(3.0,)], "x double")
    assert [r["value"] for r in quantiles.exact_quantiles(one, ["x"], 4).collect()] == [3.0] * 3
    assert quantiles.exact_quantiles(one.limit(0), ["x"], 4).collect() == []


@pytest.fixture(scope="module")
def populations(spark):
    rng = np.random.default_rng(9)
    make = lambda n, shift: [(float(x) + shift if i % 17 else None, int(k), c) for i, (x, k, c) in enumerate(zip(rng.normal(size=n), rng.integers(0, 5, n), rng.choice(["a", "b", None], n)))]
    rows = {"base": make(400, 0.0), "same": make(300, 0.0), "moved": make(200, 1.0), "few": make(3, 9.0)}
    return rows, {k: spark.createDataFrame(v, "x double, k int, c string") for k, v in rows.items()}


def test_bins_are_common_and_equally_full(populations):
    rows, frames = populations
    edges = distributions.common_edges(frames["base"], ["x", "k"], 10)
    assert len(edges["x"]) == 9 and edges["k"] == [0.0, 1.0, 2.0, 3.0, 4.0][: len(edges["k"])]
    got = distributions.binned_distribution(frames, edges, ["c"]).collect()
    for name, own in rows.items():
        for j, column in enumerate(("x", "k", "c")):
            want: dict[str, int] = {}
            for r in own:
                v = r[j]
                b = "-1" if v is None else v if column == "c" else str(sum(v > e for e in edges[column]))
                want[b] = want.get(b, 0) + 1
            mine = {g["bin"]: g["n"] for g in got if g["population"] == name and g["column"] == column}
            assert mine == want
            assert sum(g["share"] for g in got if g["population"] == name and g["column"] == column) == pytest.approx(1)
    full = [g["n"] for g in got if g["population"] == "base" and g["column"] == "x" and g["bin"] != "-1"]
    assert max(full) - min(full) <= 1


def test_drift_against_plain_distances(populations):
    rows, frames = populations
    got = {(r["population"], r["column"]): r for r in distributions.drift(frames, "base", ["x", "k"], ["c"], bins=10).collect()}
    assert len(got) == 9
    for name in ("same", "moved", "few"):
        for j, column in enumerate(("x", "k")):
            a, b = (np.sort([r[j] for r in rows[p] if r[j] is not None]) for p in (name, "base"))
            grid = np.concatenate((a, b))
            gap = np.abs(np.searchsorted(a, grid, "right") / len(a) - np.searchsorted(b, grid, "right") / len(b)).max()
            assert got[name, column]["ks"] == pytest.approx(gap)
        assert got[name, "c"]["ks"] is None and got[name, "c"]["psi"] >= 0
        counts = {p: {v: sum(r[2] == v for r in rows[p]) + 0.5 for v in ("a", "b", None)} for p in (name, "base")}
        share = {p: {v: n / sum(c.values()) for v, n in c.items()} for p, c in counts.items()}
        psi = sum((share[name][v] - share["base"][v]) * math.log(share[name][v] / share["base"][v]) for v in ("a", "b", None))
        assert got[name, "c"]["psi"] == pytest.approx(psi)
    assert got["moved", "x"]["psi"] > 0.25 > got["same", "x"]["psi"]


def test_exact_profile(spark):
    df = spark.createDataFrame([(float(i), i % 3) for i in range(1, 101)], "x double, y int")
    got = {r["column"]: r for r in distributions.exact_profile(df, ["x", "y"]).collect()}
    assert [got["x"][c] for c in ("n", "min", "p25", "p50", "p75", "max")] == [100, 1.0, 25.0, 50.0, 75.0, 100.0]
    assert [got["y"][c] for c in ("min", "p25", "p50", "p75", "max")] == [0.0, 0.0, 1.0, 2.0, 2.0]
