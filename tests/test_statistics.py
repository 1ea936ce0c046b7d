from __future__ import annotations

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import SparkSession, functions as F

from zonalis.operators import statistics as st
from zonalis.operators import stepwise
from zonalis.operators.stepwise import forward_path, forward_selection, forward_selections, hash_fold, stratified_folds
from zonalis.plans import reports


def test_correlation_skips_incomplete_rows_and_constants(spark: SparkSession) -> None:
    rng = np.random.default_rng(1)
    data = rng.normal(size=(200, 3))
    data[:, 1] += data[:, 0]
    rows = [(*map(float, r), 7.0) for r in data] + [(None, 1.0, 1.0, 7.0), (float("nan"), 1.0, 1.0, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    got = {(r.var, r.var_cor): r["corr"] for r in st.correlation_matrix(df, ["a", "b", "c", "k"]).collect()}
    want = np.corrcoef(data.T)
    for i, x in enumerate("abc"):
        for j, y in enumerate("abc"):
            assert got[x, y] == pytest.approx(want[i, j], abs=1e-9)
    assert got["a", "k"] is None and got["k", "k"] is None


@pytest.mark.parametrize("mean", [1e6, 1e8, 1e9])
def test_correlations_survive_large_means(spark: SparkSession, mean: float) -> None:
    rng = np.random.default_rng(2)
    x = rng.normal(size=300)
    y = x + rng.normal(size=300)
    rows = [(float(a) + mean, float(b) + mean, 0.1 * 3) for a, b in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, k double").repartition(5)
    got = {(r.var, r.var_cor): r["corr"] for r in st.correlation_matrix(df, ["a", "b", "k"]).collect()}
    assert got["a", "b"] == got["b", "a"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-6)
    assert got["k", "k"] is None and got["a", "k"] is None and len(got) == 9
    some = st.correlation_matrix(df, ["a", "b", "k"], ["a"], ["b", "k"]).collect()
    assert {(r.var, r.var_cor) for r in some} == {("a", "b"), ("a", "k")}


def test_forward_selection_survives_large_means(spark: SparkSession) -> None:
    x, y = _data()
    rows = [(i, *map(float, r + 1e9), float(v) + 1e9) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    names = [f"x{k}" for k in range(x.shape[1])]
    df = spark.createDataFrame(rows, ["id", *names, "y"])
    model = forward_selection(df, "y", names, F.lit(0) + F.col("id").cast("int") % 5, 3)
    steps = _greedy(x, y, 3)
    assert [s.added for s in model.path] == [names[c] for c, *_ in steps]
    assert [s.rss for s in model.path] == pytest.approx([rss for _, rss, _ in steps], rel=1e-4)
    assert model.rows == len(rows)


def test_t_quantiles(spark: SparkSession) -> None:
    known = {1: 12.7062, 2: 4.3027, 3: 3.1824, 4: 2.7764, 5: 2.5706, 6: 2.4469, 7: 2.3646, 8: 2.3060, 9: 2.2622, 10: 2.2281}
    known |= {29: 2.0452, 30: 2.0423, 31: 2.0395, 1000: 1.9623}
    df = spark.createDataFrame([(k,) for k in known], "n int")
    for r in df.select("n", st.t_quantile(F.col("n")).alias("t")).collect():
        assert r.t == pytest.approx(known[r.n], abs=6e-5)


def test_line_and_band(spark: SparkSession) -> None:
    x = np.arange(20.0)
    y = 2 * x + 5 + np.where(x % 2 == 0, 1.0, -1.0)
    df = spark.createDataFrame([("f", float(a), float(b)) for a, b in zip(x, y, strict=True)] + [("one", 1.0, 1.0)], "facet string, x double, y double")
    lines = {r.facet: r for r in st.regression_lines(df, "facet", "x", "y").collect()}
    slope, intercept = np.polyfit(x, y, 1)
    assert (lines["f"].slope, lines["f"].intercept) == pytest.approx((slope, intercept))
    assert lines["one"].slope is None and lines["one"].sigma is None
    drawn = st.band(st.regression_lines(df.filter("facet = 'f'"), "facet", "x", "y"), "facet").collect()
    assert len(drawn) == 80
    middle = min(drawn, key=lambda r: r.high - r.low)
    assert abs(middle.x - x.mean()) < 0.3
    sigma = np.sqrt(((y - slope * x - intercept) ** 2).sum() / 18)
    assert middle.high - middle.low == pytest.approx(2 * 2.1009 * sigma / np.sqrt(20), rel=1e-2)


def _data(n: int = 400) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    x = rng.uniform(0, 50, size=(n, 5))
    x = np.column_stack([x, 100 - x[:, 0]])
    return x, 3 * x[:, 0] - 2 * x[:, 1] + 0.5 * x[:, 2] + rng.normal(size=n) * 10


def _greedy(x: np.ndarray, y: np.ndarray, size: int) -> list[tuple[int, float, np.ndarray]]:
    chosen: list[int] = []
    steps = []
    for _ in range(size):
        best = None
        for c in range(x.shape[1]):
            if c in chosen:
                continue
            m = np.column_stack([np.ones(len(y)), x[:, [*chosen, c]]])
            if np.linalg.matrix_rank(m) < m.shape[1]:
                continue
            beta, *_ = np.linalg.lstsq(m, y, rcond=None)
            rss = float(((y - m @ beta) ** 2).sum())
            if best is None or rss < best[1] - 1e-6:
                best = (c, rss, beta)
        if best is None:
            break
        chosen.append(best[0])
        steps.append(best)
    return steps


def test_forward_path_equals_refitting() -> None:
    x, y = _data()
    names = [f"x{i}" for i in range(6)]
    got = forward_path(st.Moments.of(np.column_stack([x, y])), names, 6)
    want = _greedy(x, y, 6)
    assert [s.added for s in got] == [names[c] for c, _, _ in want]
    assert len(got) == 5  # x0 and x5 add to 100
    assert [s.rss for s in got] == pytest.approx([r for _, r, _ in want], rel=1e-8)
    assert all(a.rss >= b.rss for a, b in zip(got, got[1:], strict=False))
    chosen = [c for c, _, _ in want[:4]]
    assert list(got[3].coefficients.values()) == pytest.approx(list(want[3][2]), rel=1e-6)
    assert list(got[3].coefficients)[1:] == [names[c] for c in chosen]


def test_cross_validation_equals_refitting(spark: SparkSession) -> None:
    x, y = _data(120)
    names = [f"x{i}" for i in range(6)]
    rows = [(i, i % 10, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "id int, fold int, " + ", ".join(f"{n} double" for n in names) + ", y double")
    model = forward_selection(df, "y", names, F.col("fold"), 3)
    got = {r.nvmax: r for r in model.cv_results().collect()}
    fold = np.arange(120) % 10
    for size in (1, 2, 3):
        scores = []
        for f in range(10):
            train, test = fold != f, fold == f
            steps = _greedy(x[train], y[train], size)
            chosen = [c for c, _, _ in steps]
            p = np.column_stack([np.ones(test.sum()), x[test][:, chosen]]) @ steps[-1][2]
            e = y[test] - p
            scores.append((np.sqrt((e**2).mean()), np.corrcoef(p, y[test])[0, 1] ** 2, np.abs(e).mean()))
        mean, sd = np.mean(scores, axis=0), np.std(scores, axis=0, ddof=1)
        assert [got[size].rmse, got[size].rsquared, got[size].mae] == pytest.approx(mean, rel=1e-6)
        assert [got[size].rmse_sd, got[size].rsquared_sd, got[size].mae_sd] == pytest.approx(sd, rel=1e-6)


def test_folds_partition_the_rows(spark: SparkSession) -> None:
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    sizes = df.groupBy(hash_fold(["k"]).alias("f")).count().collect()
    assert sorted(r.f for r in sizes) == list(range(10)) and sum(r["count"] for r in sizes) == 1000


def test_report_series(spark: SparkSession) -> None:
    columns = ["paso19_cand_FdT", "paso19_cand_JxC", "pres19_cand_FdT", "pres19_cand_JxC", "ho_fijo", *reports.PERON_FACETS, *reports.MACRI_FACETS]
    df = spark.createDataFrame([[50.0, 40.0, 48.0, 42.0, 10.0, *[5.0] * 4, *[80.0] * 3, 70.0], [None] * len(columns)], ", ".join(f"{c} double" for c in columns))
    assert {r.facet for r in reports.peron_series(df).collect()} == set(reports.PERON_FACETS.values())
    assert reports.macri_series(df).count() == 3  # the computer facet starts at 75
    ranked = reports.landline_series(df).orderBy("facet_rank").collect()
    assert [(r.facet, r.facet_rank) for r in ranked] == [("Frente de Todos", 0), ("Frente Juntos por el Cambio", 1)]
    pairs = {r.facet: r["diff"] for r in reports.pairs_2019(df).collect()}
    assert pairs == {"Frente de Todos": -2.0, "Juntos por el Cambio": 2.0}


def test_moments_merge_in_any_order() -> None:
    rng = np.random.default_rng(3)
    rows = np.column_stack([rng.normal(size=(500, 2)) + 1e9, np.full(500, 0.1 * 3)])
    cuts = np.sort(rng.choice(np.arange(1, 500), 9, replace=False))
    parts = [st.Moments.of(p) for p in np.split(rows, cuts)]
    rng.shuffle(parts)
    while len(parts) > 1:
        parts.append(parts.pop(0) + parts.pop(0))
    [m] = parts
    assert m.n == 500 and m.mean[2] == 0.1 * 3 and (m.co[2] == 0).all()
    apart = rows[:, :2] - rows[0, :2]
    assert m.co[:2, :2] == pytest.approx(np.cov(apart.T) * 499, rel=1e-6)


@pytest.mark.parametrize("merged", [1, 3, 512])
def test_one_pass_serves_all_models(spark: SparkSession, monkeypatch: pytest.MonkeyPatch, merged: int) -> None:
    """Outcomes with gaps in different rows and folds of their own, against one model at a time on its complete rows."""
    monkeypatch.setattr(st, "MERGED", merged)
    x, y = _data(200)
    rng = np.random.default_rng(5)
    names = [f"x{k}" for k in range(6)]
    outcomes = {f"y{k}": [None if rng.random() < 0.2 else float(v) for v in y * (k + 1) + rng.normal(size=200) * 30] for k in range(3)}
    x[3, 1] = np.nan
    rows = [(i, *map(float, r), *[v[i] for v in outcomes.values()]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} double" for n in [*names, *outcomes])).repartition(5)
    folds = {name: F.col("id") % (4 + k) for k, name in enumerate(outcomes)}
    together = forward_selections(df, names, folds, 3)
    for name, fold in folds.items():
        whole = st.complete_rows(df, [*names, name])
        alone = forward_selection(whole, name, names, fold, 3)
        steps = _greedy(np.array([[r[n] for n in names] for r in whole.collect()]), np.array([r[name] for r in whole.collect()]), 3)
        got = together[name]
        assert got.rows == alone.rows == whole.count()
        assert [s.added for s in got.path] == [s.added for s in alone.path] == [names[c] for c, *_ in steps]
        assert [s.rss for s in got.path] == pytest.approx([rss for _, rss, _ in steps], rel=1e-6)
        pairs = [sorted(map(tuple, m.cv_results().collect())) for m in (got, alone)]
        assert np.array(pairs[0]) == pytest.approx(np.array(pairs[1]))


def test_one_scan_for_the_matrix_and_for_all_scores(spark: SparkSession, tmp_path: Path) -> None:
    spark.range(50).selectExpr("id", "rand(1) AS a", "rand(2) AS b", "rand(3) AS y", "rand(4) AS z").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = st.correlation_matrix(df, ["a", "b", "y"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == plan.count("MapInArrow") == 1 and "Join" not in plan
    found = forward_selections(df, ["a", "b"], {"y": F.col("id") % 3, "z": F.col("id") % 5}, 2)
    plan = found["z"].cv_results()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == plan.count("MapInArrow") == 1


@pytest.mark.parametrize("rows_per_slice", [30, 200_000])
def test_folds_hold_equal_parts_of_each_stratum(spark: SparkSession, monkeypatch: pytest.MonkeyPatch, rows_per_slice: int) -> None:
    monkeypatch.setattr(stepwise, "SLICE", rows_per_slice)
    rng = np.random.default_rng(6)
    values = [*map(float, rng.lognormal(size=400)), *[7.5] * 30, None, float("nan"), float("inf")]
    df = spark.createDataFrame([(i, v, 3.0 if i % 2 else None) for i, v in enumerate(values)], "id int, y double, c double").repartition(6)
    dealt = stratified_folds(df, ["y", "c"], ["id"])
    assert dealt.columns == ["id", "y", "c", "fold_y", "fold_c"] and dealt.count() == len(values)
    rows = dealt.collect()
    finite = sorted((r.y, r.fold_y) for r in rows if r.y is not None and np.isfinite(r.y))
    assert all(r.fold_y is None for r in rows if r.y is None or not np.isfinite(r.y))
    assert {r.fold_c for r in rows if r.c is None} == {None}
    sizes = np.bincount([r.fold_c for r in rows if r.c is not None], minlength=10)
    assert sizes.max() - sizes.min() <= 1
    # strata are stretches of the sorted values; each of the quarters is told to a step of the grid
    step = (finite[-1][0] - finite[0][0]) / stepwise.GRID
    ends = [finite[len(finite) * q // 4][0] for q in (1, 2, 3)]
    for low, high in zip([-1.0, *ends], [*ends, 1e9], strict=True):
        inner = np.bincount([f for v, f in finite if low + step < v < high - step], minlength=10)
        assert inner.max() - inner.min() <= 4
    whole = np.bincount([f for _, f in finite], minlength=10)
    assert whole.max() - whole.min() <= 4
    assert sorted(map(tuple, dealt.select("id", "fold_y").collect())) == sorted(map(tuple, stratified_folds(df.repartition(2), ["y"], ["id"]).select("id", "fold_y").collect()))
    assert stratified_folds(df.limit(0), ["y"], ["id"]).collect() == []
