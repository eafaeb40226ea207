"""Profiles of the credit and spend tables; regression and its errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators import profile
from tidemark.operators.running import group_quantiles
from tidemark.plans import regression as reg
from tidemark.plans.metrics import regression_metrics
from tidemark.sources.samples import CREDIT_CATEGORIES, CREDIT_NUMBERS, SampleTables
from tidemark.suite.base import query
from tidemark.suite.sqltext import CREDIT, SPEND

CATEGORIES = ["purpose", "credit_standing", "housing", *[name for name, *_ in CREDIT_CATEGORIES]]
COUNTS = [name for name, *_ in CREDIT_NUMBERS]
NUMBERS = ["credit_request_id", "credit_amount", *COUNTS, "age", "checking_balance", "savings_balance"]
PREDICTORS = ["session_length", "time_on_app", "time_on_website", "membership_length"]
FIVE = {"low": 0.0, "lower_quartile": 0.25, "median": 0.5, "upper_quartile": 0.75, "high": 1.0}
FIXED_SQL = "(1500.0::DOUBLE * session_length + 100.0::DOUBLE * membership_length + 12.5::DOUBLE)"



def _fixed_line() -> Column:
    return F.col("session_length") * 1500.0 + F.col("membership_length") * 100.0 + 12.5


_TYPES = {
    "credit_request_id": "bigint", "credit_amount": "double", **dict.fromkeys(COUNTS, "int"), "age": "int",
    "checking_balance": "double", "savings_balance": "double", **dict.fromkeys(CATEGORIES, "string"),
}


@query(
    "credit_table_profile",
    f"WITH {CREDIT} " + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{k}' AS data_type, COUNT(*) AS row_count, COUNT({c}) AS non_null_count FROM credit"
        for i, (c, k) in enumerate(_TYPES.items())
    ),
)
def credit_table_profile(t: SampleTables) -> DataFrame:
    return profile.table_profile(t.credit_files())


@query(
    "credit_statistics",
    f"WITH {CREDIT} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
        CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM credit"""
        for c in NUMBERS
    ),
)
def credit_statistics(t: SampleTables) -> DataFrame:
    return profile.describe(t.credit_files()).withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    "credit_category_counts",
    f"WITH {CREDIT} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS category, COUNT(*) AS row_count FROM credit GROUP BY {c}" for c in CATEGORIES
    ),
)
def credit_category_counts(t: SampleTables) -> DataFrame:
    """Every category column, found by its type."""
    return profile.category_counts(t.credit_files())


def _histogram_sql(table: str, columns: list[str], bins: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(b AS INTEGER) AS bin, round(lo + (hi - lo) * b / {bins}, 6) AS bin_start,
        round(lo + (hi - lo) * (b + 1) / {bins}, 6) AS bin_end, COUNT(x) AS row_count
        FROM (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM {table}) r
        CROSS JOIN range({bins}) g(b)
        LEFT JOIN (SELECT CAST({c} AS DOUBLE) AS x FROM {table}) v
          ON b = least(CAST(floor((x - lo) / (hi - lo) * {bins}) AS BIGINT), {bins - 1})
        GROUP BY ALL"""
        for c in columns
    )


def _rounded(h: DataFrame) -> DataFrame:
    return h.withColumns({c: F.round(c, 6) for c in ("bin_start", "bin_end")})


@query("credit_histograms", f"WITH {CREDIT} " + _histogram_sql("credit", NUMBERS, 10))
def credit_histograms(t: SampleTables) -> DataFrame:
    """Every numeric column, found by its type."""
    return _rounded(profile.histogram(t.credit_files()))


@query(
    "credit_amount_quantiles",
    f"WITH {CREDIT} SELECT purpose, credit_standing, COUNT(credit_amount) AS n, " + ", ".join(
        f"round(quantile_cont(credit_amount, {q}), 6) AS {n}" for n, q in FIVE.items()
    ) + " FROM credit GROUP BY purpose, credit_standing",
)
def credit_amount_quantiles(t: SampleTables) -> DataFrame:
    out = group_quantiles(t.credit_files(), "credit_amount", ["purpose", "credit_standing"], FIVE)
    return out.withColumns({c: F.round(c, 6) for c in FIVE})


@query("credit_amount_points", f"WITH {CREDIT} SELECT purpose, credit_standing, credit_amount FROM credit")
def credit_amount_points(t: SampleTables) -> DataFrame:
    return t.credit_files().select("purpose", "credit_standing", "credit_amount")


_ALL = [*PREDICTORS, "spent"]


@query(
    "spend_correlations",
    f"WITH {SPEND} " + " UNION ALL ".join(
        f"SELECT '{a}' AS column_name, " + ", ".join(f"round(corr({a}, {b}), 6) AS {b}" for b in _ALL) + " FROM spend"
        for a in _ALL
    ),
)
def spend_correlations(t: SampleTables) -> DataFrame:
    square = profile.correlation_matrix(t.spend(), _ALL)
    return square.select("column_name", *[F.round(c, 6).alias(c) for c in _ALL])


@query(
    "spend_pair_correlation",
    f"WITH {SPEND} SELECT round(corr(spent, session_length), 6) AS r FROM spend",
)
def spend_pair_correlation(t: SampleTables) -> DataFrame:
    return t.spend().agg(F.round(profile.correlation("spent", "session_length"), 6).alias("r"))


@query(
    "spend_split",
    f"WITH {SPEND} SELECT CASE WHEN in_train THEN 'train' ELSE 'test' END AS part, COUNT(*) AS row_count, "
    "CAST(SUM(l_orderkey) AS BIGINT) AS key_sum FROM spend GROUP BY 1",
)
def spend_split(t: SampleTables) -> DataFrame:
    train, test = reg.split_by_key(t.spend(), ["l_orderkey", "l_linenumber"])
    both = train.select(F.lit("train").alias("part"), "l_orderkey").union(
        test.select(F.lit("test").alias("part"), "l_orderkey")
    )
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("row_count"), F.sum("l_orderkey").alias("key_sum"))


def _least_squares_sql() -> str:
    """Weights by successive residuals: each step takes one predictor out of all later columns."""
    steps, source = [], "fit_0"
    names = [f"x{i}" for i in range(1, 5)]
    steps.append(
        f"fit_0 AS (SELECT {', '.join(f'{c} AS x{i + 1}' for i, c in enumerate(PREDICTORS))}, spent AS y FROM spend WHERE in_train)"
    )
    for step in range(1, 4):
        rest = [*names[step:], "y"]
        by = names[step - 1]
        slopes = ", ".join(f"regr_slope({c}, {by}) AS s_{c}, regr_intercept({c}, {by}) AS i_{c}" for c in rest)
        steps.append(f"line_{step} AS (SELECT {slopes} FROM {source})")
        kept = ", ".join(f"{c} - (s_{c} * {by} + i_{c}) AS {c}" for c in rest)
        steps.append(f"fit_{step} AS (SELECT {kept} FROM {source}, line_{step})")
        source = f"fit_{step}"
    steps.append("b4 AS (SELECT regr_slope(y, x4) AS w FROM fit_3)")
    steps.append("b3 AS (SELECT regr_slope(y - (SELECT w FROM b4) * x4, x3) AS w FROM fit_2)")
    steps.append("b2 AS (SELECT regr_slope(y - (SELECT w FROM b4) * x4 - (SELECT w FROM b3) * x3, x2) AS w FROM fit_1)")
    left = "y - (SELECT w FROM b4) * x4 - (SELECT w FROM b3) * x3 - (SELECT w FROM b2) * x2"
    steps.append(f"b1 AS (SELECT regr_slope({left}, x1) AS w, regr_intercept({left}, x1) AS i FROM fit_0)")
    return ",\n".join(steps)


@query(
    "spend_coefficients",
    f"WITH {SPEND}, {_least_squares_sql()} " + " UNION ALL ".join(
        f"SELECT '{c}' AS term, round(w, 2) AS coefficient FROM b{i + 1}" for i, c in enumerate(PREDICTORS)
    ) + " UNION ALL SELECT 'intercept', round(i, 2) FROM b1",
)
def spend_coefficients(t: SampleTables) -> DataFrame:
    train, _ = reg.split_by_key(t.spend(), ["l_orderkey", "l_linenumber"])
    return reg.coefficients(train, reg.fit_least_squares(train, "spent", PREDICTORS), PREDICTORS)


def _fitted_test(t: SampleTables) -> tuple[DataFrame, object]:
    train, test = reg.split_by_key(t.spend(), ["l_orderkey", "l_linenumber"])
    return test, reg.predicted(reg.fit_least_squares(train, "spent", PREDICTORS), PREDICTORS)


_FIT_LINE = """line AS (SELECT b1.w AS w1, b2.w AS w2, b3.w AS w3, b4.w AS w4, b1.i AS i FROM b1, b2, b3, b4),
predicted AS (SELECT spent, i + session_length * w1 + time_on_app * w2 + time_on_website * w3 + membership_length * w4 AS p
              FROM spend, line WHERE NOT in_train)"""


@query(
    "spend_model_errors",
    f"""WITH {SPEND}, {_least_squares_sql()}, {_FIT_LINE}
    SELECT round(avg(abs(spent - p)), 2) AS mae, round(avg((spent - p) ** 2), 0) AS mse,
           round(sqrt(avg((spent - p) ** 2)), 2) AS rmse, round(1 - avg((spent - p) ** 2) / var_pop(spent), 6) AS r2 FROM predicted""",
)
def spend_model_errors(t: SampleTables) -> DataFrame:
    test, line = _fitted_test(t)
    out = regression_metrics(test, "spent", line)
    return out.select(
        F.round("mae", 2).alias("mae"), F.round("mse", 0).alias("mse"), F.round("rmse", 2).alias("rmse"),
        F.round("r2", 6).alias("r2"),
    )


@query(
    "fixed_line_errors",
    f"""WITH {SPEND} SELECT round(avg(abs(spent - {FIXED_SQL})), 4) AS mae, round(avg((spent - {FIXED_SQL}) ** 2), 2) AS mse,
           round(sqrt(avg((spent - {FIXED_SQL}) ** 2)), 4) AS rmse,
           round(1 - avg((spent - {FIXED_SQL}) ** 2) / var_pop(spent), 6) AS r2 FROM spend""",
)
def fixed_line_errors(t: SampleTables) -> DataFrame:
    out = regression_metrics(t.spend(), "spent", _fixed_line())
    return out.select(
        F.round("mae", 4).alias("mae"), F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"),
        F.round("r2", 6).alias("r2"),
    )


@query(
    "residual_rows",
    f"WITH {SPEND} SELECT l_orderkey, l_linenumber, round({FIXED_SQL} - spent, 6) AS residual FROM spend WHERE NOT in_train",
)
def residual_rows(t: SampleTables) -> DataFrame:
    _, test = reg.split_by_key(t.spend(), ["l_orderkey", "l_linenumber"])
    out = reg.residuals(test, "spent", _fixed_line())
    return out.select("l_orderkey", "l_linenumber", F.round("residual", 6).alias("residual"))


_RESIDUAL = f"WITH {SPEND}, res AS (SELECT round({FIXED_SQL} - spent, 6) AS residual FROM spend WHERE NOT in_train) "


@query("residual_histogram", _RESIDUAL + _histogram_sql("res", ["residual"], 50))
def residual_histogram(t: SampleTables) -> DataFrame:
    return _rounded(profile.histogram(residual_rows(t), ["residual"], 50))


@query(
    "residual_density",
    _RESIDUAL.rstrip() + """,
    s AS (SELECT min(residual) AS lo, max(residual) AS hi, COUNT(*) AS n,
                 stddev_samp(residual) * pow(COUNT(*), -0.2) AS h FROM res),
    grid AS (SELECT CAST(g AS INTEGER) AS grid_point, lo + (hi - lo) * g / 199 AS position, n, h FROM s, range(200) r(g))
    SELECT grid_point, round(position, 4) AS position,
           round(SUM(exp(-(((position - residual) / h) ** 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 12) AS density
    FROM grid, res GROUP BY grid_point, position""",
)
def residual_density(t: SampleTables) -> DataFrame:
    out = profile.density(residual_rows(t), "residual")
    return out.select("grid_point", F.round("position", 4).alias("position"), F.round("density", 12).alias("density"))
