"""M11–M13 from merged states equal the direct computation."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.operators import models as M
from shoplens.operators import moments as C
from shoplens.operators import weather as W

COLUMNS = ["a", "b", "c"]


def days(spark, seed=1, n=300):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = rng.gauss(1e6, 3) if rng.random() < 0.95 else rng.choice([None, float("nan")])
        rows.append((dt.date(2020, 1, 1) + dt.timedelta(days=i), a, rng.gauss(-5, 100), (a or 0) * 2 + rng.gauss(0, 5) if a == a else 1.0))
    return rows, spark.createDataFrame(rows, "day date, a double, b double, c double")


def table(df):
    return {(r["variable_1"], r["variable_2"]): r["pearson_corr"] for r in df.collect()}


def test_parts_merge_to_the_whole(spark):
    rows, df = days(spark)
    centre = C.centre_of(df, COLUMNS)
    whole = table(W.correlation_matrix(df, COLUMNS))
    months = C.co_moments(df, COLUMNS, centre, [F.trunc("day", "month").alias("month")])
    late = C.co_moments(df.filter(F.dayofmonth("day") > 20), COLUMNS, centre, [F.trunc("day", "month").alias("month")])
    early = C.co_moments(df.filter(F.dayofmonth("day") <= 20), COLUMNS, centre, [F.trunc("day", "month").alias("month")])
    assert table(C.correlation_from(months, COLUMNS)) == whole == table(C.correlation_from(late.unionByName(early), COLUMNS))
    clean = np.array([r[1:] for r in rows if all(v is not None and v == v for v in r[1:])])
    for (x, y), r in whole.items():
        assert r == pytest.approx(np.corrcoef(clean.T)[COLUMNS.index(x), COLUMNS.index(y)], abs=6e-5)
    # A span of some months.
    some = months.filter("month between '2020-02-01' and '2020-04-01'")
    assert table(C.correlation_from(some, COLUMNS)) == table(
        W.correlation_matrix(df.filter("day between '2020-02-01' and '2020-04-30'"), COLUMNS))


def test_constant_columns_and_no_rows(spark):
    df = spark.createDataFrame([(0.1 + 0.2, float(i), 7e9) for i in range(50)], "a double, b double, c double")
    got = table(C.correlation_from(C.co_moments(df, COLUMNS, {"a": 0.0, "b": 20.0, "c": 1.0}), COLUMNS))
    assert math.isnan(got["a", "b"]) and math.isnan(got["b", "c"]) and got["a", "a"] == got["b", "b"] == 1.0
    empty = C.co_moments(df.limit(0), COLUMNS, C.centre_of(df.limit(0), COLUMNS), [F.lit("x").alias("k")])
    assert C.correlation_from(empty, COLUMNS).count() == 0


def test_states_about_other_centres_are_refused(spark):
    _, df = days(spark)
    one = C.co_moments(df, COLUMNS, {"a": 0.0, "b": 0.0, "c": 0.0})
    two = C.co_moments(df, COLUMNS, {"a": 1.0, "b": 0.0, "c": 0.0})
    with pytest.raises(Exception, match="different centres"):
        C.merge_moments(one.unionByName(two), COLUMNS).collect()


def test_cholesky_solves(spark):
    rng = np.random.default_rng(3)
    g = rng.normal(size=(5, 5))
    a, b = g @ g.T + np.eye(5), rng.normal(size=5)
    row = C.cholesky_solve(spark.range(1), {(i, j): F.lit(float(a[i, j])) for i in range(5) for j in range(5)},
                           [F.lit(float(v)) for v in b], "x").first()
    assert [row[f"x{i}"] for i in range(5)] == pytest.approx(np.linalg.solve(a, b).tolist(), rel=1e-9)


@pytest.mark.parametrize("seed", [1, 2])
def test_the_regression_is_that_of_the_fit(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        x = [rng.gauss(15, 8), abs(rng.gauss(0, 2)), rng.gauss(5, 2) if rng.random() < 0.97 else None, rng.uniform(20, 90)]
        y = 100 + 3 * x[0] - 7 * x[1] + 0.5 * (x[2] or 0) + rng.gauss(0, 20)
        rows.append((i, *x, int(y)))
    f = list(M.REGRESSION_FEATURES)
    df = spark.createDataFrame(rows, ", ".join(["day long", *[f"{c} double" for c in f], "purchase_count long"]))
    want = M.regression_metrics(df, key="day").first().asDict()
    from shoplens.operators.sampling import with_split

    columns = [*f, "purchase_count"]
    state = C.co_moments(with_split(df, "day"), columns, C.centre_of(df, columns), [(F.col("day") % 7).alias("week"), F.col("split")])
    got = C.regression_from(state).first().asDict()
    assert list(got) == list(want) and all(got[k] == pytest.approx(want[k], abs=1.1e-4) if isinstance(want[k], float) else got[k] == want[k]
                                           for k in want)
