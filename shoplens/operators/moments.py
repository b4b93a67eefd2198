"""Mergeable co-moments for M11, M12 and M13.

The state of any set of rows is their number, the sums of each variable and
the sums of every product of two, about a fixed centre. States add up, so
each day (or part of one) is read once, and correlations and a linear
regression over any span come from the sum of stored states: no second scan
of the days and no iterative fit. The centre lies near the data, so that the
sums stay small and their differences exact enough; it is kept in the state
and must be the same in all parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import DEFAULT
from .models import COEFFICIENT_NAMES, REGRESSION_FEATURES
from .weather import CORRELATION_COLUMNS

#: Below this share of a variable's mean square about the centre, its variance is rounding.
CONSTANT = 1e-13


def _s(a: str) -> str:
    return f"s__{a}"


def _p(a: str, b: str, columns: Sequence[str]) -> str:
    a, b = sorted((a, b), key=list(columns).index)
    return f"p__{a}__{b}"


def _c(a: str) -> str:
    return f"c__{a}"


def centre_of(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """A centre for states of this data: the means, to six digits."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return {c: float(f"{row[c]:.6g}") if row[c] is not None and row[c] == row[c] else 0.0 for c in columns}


def co_moments(df: DataFrame, columns: Sequence[str], centre: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """State of the rows per key: (``by``, n, sums, products, centre). Rows
    with a null or NaN in any column are skipped, as a vector assembler with
    ``skip`` does. One aggregation, partial before its shuffle."""
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    x = {c: F.col(c).cast("double") - F.lit(centre[c]) for c in columns}
    state = df.filter(ok).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x[c]).alias(_s(c)) for c in columns],
        *[F.sum(x[a] * x[b]).alias(_p(a, b, columns)) for a, b in combinations_with_replacement(columns, 2)])
    return state.withColumns({_c(c): F.lit(centre[c]) for c in columns})


def merge_moments(state: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sum of states under fewer keys; parts with another centre fail the job."""
    sums = ["n", *[_s(c) for c in columns], *[_p(a, b, columns) for a, b in combinations_with_replacement(columns, 2)]]
    one = [F.when(F.min(_c(c)).eqNullSafe(F.max(_c(c))), F.min(_c(c)))
           .otherwise(F.raise_error(F.lit(f"states of {c} have different centres")).cast("double")).alias(_c(c)) for c in columns]
    return state.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums], *one)


def _covariance(a: str, b: str, columns: Sequence[str]) -> Column:
    return F.col(_p(a, b, columns)) / F.col("n") - F.col(_s(a)) / F.col("n") * (F.col(_s(b)) / F.col("n"))


def _variance(a: str, columns: Sequence[str]) -> Column:
    v = _covariance(a, a, columns)
    return F.when(v > CONSTANT * F.col(_p(a, a, columns)) / F.col("n"), v).otherwise(F.lit(0.0))


def correlation_from(state: DataFrame, columns: Sequence[str] = CORRELATION_COLUMNS, digits: int = 4) -> DataFrame:
    """M11 from states: Pearson correlation of every pair, long form. The
    diagonal is 1.0; pairs with a constant column are NaN; no rows: no cells."""
    total = merge_moments(state, columns).filter("n > 0")
    sd = total.withColumns({f"sd__{c}": F.sqrt(_variance(c, columns)) for c in columns})

    def r(a: str, b: str) -> Column:
        if a == b:
            return F.lit(1.0)
        scale = F.col(f"sd__{a}") * F.col(f"sd__{b}")
        return F.round(F.when(scale == 0, F.lit(float("nan"))).otherwise(_covariance(a, b, columns) / scale), digits)

    cells = [F.struct(F.lit(a).alias("variable_1"), F.lit(b).alias("variable_2"), r(a, b).alias("pearson_corr"))
             for a in columns for b in columns]
    return sd.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def cholesky_solve(row: DataFrame, matrix: Mapping[tuple[int, int], Column], right: Sequence[Column], out: str) -> DataFrame:
    """``row`` with the solution of a symmetric positive definite system as
    columns ``<out>0``, …: the factor L of L L', then L z = b and L' x = z.
    Every entry is a column of its own, computed once."""
    n = len(right)
    for j in range(n):
        for i in range(j, n):
            rest = matrix[i, j]
            for k in range(j):
                rest = rest - F.col(f"L{i}_{k}") * F.col(f"L{j}_{k}")
            row = row.withColumn(f"L{i}_{j}", F.sqrt(rest) if i == j else rest / F.col(f"L{j}_{j}"))
    for i in range(n):
        rest = right[i]
        for k in range(i):
            rest = rest - F.col(f"L{i}_{k}") * F.col(f"z{k}")
        row = row.withColumn(f"z{i}", rest / F.col(f"L{i}_{i}"))
    for i in reversed(range(n)):
        rest = F.col(f"z{i}")
        for k in range(i + 1, n):
            rest = rest - F.col(f"L{k}_{i}") * F.col(f"{out}{k}")
        row = row.withColumn(f"{out}{i}", rest / F.col(f"L{i}_{i}"))
    return row


def regression_from(state: DataFrame, features: Sequence[str] = REGRESSION_FEATURES, label: str = "purchase_count",
                    reg_param: float = DEFAULT.regression_reg_param, split: str = "split") -> DataFrame:
    """M12 + M13 from states keyed by ``split`` (``train``, ``test``): ridge
    regression of the label on the standardised features, in closed form, and
    its R² and RMSE on the test rows, as ``regression_metrics`` gives them.
    A feature that is constant in training has the coefficient 0."""
    columns = [*features, label]
    every = merge_moments(state, columns, [split])
    train = every.filter(F.col(split) == "train").drop(split)
    sd = {f"sd{i}": F.sqrt(_variance(c, columns)) for i, c in enumerate(columns)}
    t = train.withColumns(sd)
    y = F.col(f"sd{len(features)}")

    def scaled(i: int, j: int) -> Column:
        size = F.col(f"sd{i}") * F.col(f"sd{j}")
        return F.when(size == 0, 0.0).otherwise(_covariance(columns[i], columns[j], columns) / size)

    n = range(len(features))
    matrix = {(i, j): 1.0 + F.lit(reg_param) / y if i == j else scaled(i, j) for i in n for j in n}
    t = cholesky_solve(t, matrix, [scaled(i, len(features)) for i in n], "z_")
    t = t.withColumns({f"b{i}": F.when(F.col(f"sd{i}") == 0, 0.0).otherwise(F.col(f"z_{i}") * y / F.col(f"sd{i}")) for i in n})
    mean = {c: F.col(_s(c)) / F.col("n") + F.col(_c(c)) for c in columns}
    intercept = mean[label]
    for i, c in enumerate(features):
        intercept = intercept - F.col(f"b{i}") * mean[c]
    model = t.select(*[F.col(f"b{i}") for i in n], intercept.alias("b"))

    # One row each: the model's columns are scalars beside the test state.
    one = model.select(F.struct(*model.columns).alias("m")).scalar()
    test = every.filter(F.col(split) == "test").drop(split)
    m = test.withColumn("_m", one).select("*", *[F.col("_m")[c].alias(c) for c in model.columns])
    # The error is y - b x - d about the centre, d the intercept moved there.
    d = F.col("b") - F.col(_c(label))
    for i, c in enumerate(features):
        d = d + F.col(f"b{i}") * F.col(_c(c))
    m = m.withColumn("d", d)
    w = {label: F.lit(1.0)} | {c: -F.col(f"b{i}") for i, c in enumerate(features)}
    sse = F.col("n") * F.col("d") * F.col("d")
    for a in columns:
        sse = sse - 2 * F.col("d") * w[a] * F.col(_s(a))
        for b in columns:
            sse = sse + w[a] * w[b] * F.col(_p(a, b, columns))
    sst = _variance(label, columns) * F.col("n")
    m = m.withColumns({"sse": F.greatest(sse, F.lit(0.0)), "sst": sst})
    return m.select(
        F.lit("LinearRegression").alias("model"),
        F.round(F.lit(1.0) - F.try_divide("sse", "sst"), 4).alias("r2"),
        F.round(F.sqrt(F.try_divide(F.col("sse"), F.col("n").cast("double"))), 2).alias("rmse"),
        *[F.round(f"b{i}", 4).alias(COEFFICIENT_NAMES.get(c, f"coeff_{c}")) for i, c in enumerate(features)],
        F.round("b", 4).alias("intercept"), F.col("n").alias("test_rows"))
