"""Features, split, metrics and the three models."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotwise.functions import fixed
from plotwise.operators import features, least_squares, metrics
from plotwise.operators.sizes import join_fitted
from plotwise.plans import fitted, train
from plotwise.suite.display import price_text_sql
from plotwise.suite.quality import SLOT_SQL
from plotwise.suite.registry import query, sql_pick
from plotwise.suite.scalars import raw, raw_sql

_TYPES, _ZONES = sorted(fixed.TYPE_BASE_PRICE), sorted([*fixed.ZONES, fixed.UNKNOWN_ZONE])

RAW_HOMES = {
    "id": "o_orderkey",
    "property_type": sql_pick("o_custkey", _TYPES),
    "zone": sql_pick("o_orderkey", _ZONES),
    "area_sqm": "CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE CAST(o_custkey % 180 + 20 AS DOUBLE) END",
    "bedrooms": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_custkey % 5 AS DOUBLE) END",
    "bathrooms": "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST(o_custkey % 3 AS DOUBLE) END",
    "floor": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 30 AS DOUBLE) END",
    "has_bts": "CAST(o_orderkey % 2 AS INT)", "age_days": "CAST(o_orderkey % 365 AS INT)",
    "price_thb": "CASE WHEN o_orderkey % 30 = 1 THEN NULL ELSE "
                 "CAST((o_custkey % 180 + 20) * (5 + 2 * (o_custkey % 4)) * (15 - 2 * (o_orderkey % 5)) "
                 "* (1000000 + CAST(floor(o_totalprice) AS BIGINT)) AS DOUBLE) / 1000.0 END",
}


def training_rows(spark, d):
    return features.training_table(raw(spark, d, "orders", RAW_HOMES))


_TRAINING = f"""(SELECT id, area_sqm, coalesce(bedrooms, 1) AS bedrooms, coalesce(bathrooms, 1) AS bathrooms,
        CASE WHEN property_type = 'ที่ดิน' THEN 0 ELSE coalesce(floor, 1) END AS floor, has_bts,
        coalesce(age_days, 0) AS age_days, zone, property_type, price_thb
    FROM {raw_sql('orders', RAW_HOMES)} WHERE price_thb IS NOT NULL AND area_sqm IS NOT NULL)"""


@query("features_onehot", f"""
    SELECT id, area_sqm, bedrooms, bathrooms, floor, has_bts, age_days, price_thb, """
       + ", ".join(f"""CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS "{c}_{v}" """ for c, vs in
                   (("zone", _ZONES), ("property_type", _TYPES)) for v in vs) + f" FROM {_TRAINING}")
def features_onehot(spark, d):
    return features.one_hot(training_rows(spark, d))


@query("split_hash", f"""
    SELECT is_train, count(*) AS rows, CAST(sum(id) AS BIGINT) AS id_sum FROM
        (SELECT id, {SLOT_SQL.format(k='id')} < 8 AS is_train FROM {_TRAINING}) GROUP BY is_train""")
def split_hash(spark, d):
    rows = features.with_split(training_rows(spark, d))
    return rows.groupBy("is_train").agg(F.count(F.lit(1)).alias("rows"), F.sum("id").alias("id_sum"))


_EVAL = f"""
    WITH x AS (SELECT *, {SLOT_SQL.format(k='id')} < 8 AS is_train FROM {_TRAINING}),
    g AS (SELECT property_type, avg(price_thb) AS m FROM x WHERE is_train GROUP BY 1),
    s AS (SELECT price_thb AS y, (SELECT avg(price_thb) FROM x WHERE is_train) AS p0, m AS p1
          FROM x JOIN g USING (property_type) WHERE NOT is_train),
    u AS (SELECT 'Overall mean' AS model, 0 AS rank, y, p0 AS p FROM s
          UNION ALL SELECT 'Type mean', 1, y, p1 FROM s),
    e AS (SELECT model, rank, avg(abs(p - y)) AS MAE, sqrt(avg((p - y) * (p - y))) AS RMSE,
                 1 - sum((p - y) * (p - y)) / (count(*) * var_pop(y)) AS R2 FROM u GROUP BY ALL)"""


def _evaluation(spark, d):
    rows = features.with_split(training_rows(spark, d))
    fit, test = rows.filter("is_train"), rows.filter("not is_train")
    by_type = fit.groupBy("property_type").agg(F.avg("price_thb").alias("p1"))
    scored = join_fitted(test, by_type, ["property_type"], "inner").withColumn(
        "p0", fit.agg(F.avg("price_thb")).scalar())
    return metrics.metrics(scored, "price_thb", {"Overall mean": "p0", "Type mean": "p1"})


def _rounded(evaluated):
    return evaluated.select("model", "rank", F.round("MAE", 2).alias("MAE"), F.round("RMSE", 2).alias("RMSE"),
                            F.round("R2", 8).alias("R2"))


@query("eval_metrics", _EVAL + """
    SELECT model, rank, round(MAE, 2) AS MAE, round(RMSE, 2) AS RMSE, round(R2, 8) AS R2 FROM e""")
def eval_metrics(spark, d):
    return _rounded(_evaluation(spark, d))


@query("model_comparison", _EVAL + """
    SELECT model, rank, round(MAE, 2) AS MAE, round(RMSE, 2) AS RMSE, round(R2, 8) AS R2 FROM e ORDER BY e.R2 DESC, rank""")
def model_comparison(spark, d):
    return _rounded(metrics.comparison(_evaluation(spark, d)))


@query("best_model", _EVAL + "SELECT model, round(R2, 8) AS R2 FROM e ORDER BY e.R2 DESC, rank LIMIT 1")
def best_model(spark, d):
    return metrics.best_model(_evaluation(spark, d)).select("model", F.round("R2", 8).alias("R2"))


# 100 trees, 200 rounds, all three models, every row. Trees are 12 deep, as time doubles with every few levels (README).
SETTINGS = train.ModelSettings(forest_depth=12)


def least_squares_sql(rows: str, columns: dict[str, str]) -> tuple[str, str]:
    """Steps that leave ``y`` without what the columns explain, for rows (id, is_train, y, inputs); the name of the last.

    Column after column is taken out of the later ones and of y, by sums over the train rows. A
    column that the earlier ones explain is left out. The prediction is what was taken out of y.
    """
    names = [f"c{k}" for k in range(len(columns))]
    first = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in zip(names, columns.values(), strict=True))
    steps = [f"t0 AS MATERIALIZED (SELECT id, is_train, y, y AS r, {first} FROM {rows})"]
    for k, n in enumerate(names):
        later = [*names[k + 1:], "r"]
        sums = ", ".join(f"sum({n} * {x}) FILTER (is_train) AS s_{x}" for x in [n, *later])
        steps.append(f"b{k} AS MATERIALIZED (SELECT {sums}, (SELECT sum({n} * {n}) FROM t0 WHERE is_train) AS whole FROM t{k})")
        left = ", ".join(f"{x} - CASE WHEN s_{n} > 1e-9 * whole THEN {n} * s_{x} / s_{n} ELSE 0 END AS {x}" for x in later)
        steps.append(f"t{k + 1} AS MATERIALIZED (SELECT id, is_train, y, {left} FROM t{k}, b{k})")
    return ",\n    ".join(steps), f"t{len(names)}"


_INPUTS = {"one": "1", **{c: c for c in features.NUMERIC},
           **{f"{c}_{v}": f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END" for c, vs in (("zone", _ZONES), ("property_type", _TYPES)) for v in vs}}


def _metrics_sql(last: str) -> str:
    return f"""SELECT 'Linear Regression' AS model, 0 AS rank, round(avg(abs(r)), 2) AS MAE, round(sqrt(avg(r * r)), 2) AS RMSE,
        round(1 - sum(r * r) / (count(*) * var_pop(y)), 8) AS R2 FROM {last} WHERE NOT is_train"""


_SPLIT = f"(SELECT *, {SLOT_SQL.format(k='id')} < 8 AS is_train, price_thb AS y FROM {_TRAINING})"
_FIT, _FITTED = least_squares_sql(_SPLIT, _INPUTS)


@query("train_lr", f"WITH {_FIT} {_metrics_sql(_FITTED)}")
def train_lr(spark, d):
    return _rounded(train.train_and_evaluate(training_rows(spark, d), SETTINGS, names=[train.LINEAR]).evaluation)


@query("residual_sums", f"""
    WITH {_FIT}, x AS (SELECT t0.*, {_FITTED}.r AS rest FROM t0 JOIN {_FITTED} USING (id) WHERE t0.is_train)
    """ + " UNION ALL ".join(f"""SELECT '{name}' AS feature, round(sum(c{k} * y) / count(*), 1) AS mean_product,
        round(sum(c{k} * rest) / count(*) / 1e6, 6) + 0.0 AS mean_residual_millions FROM x""" for k, name in enumerate(_INPUTS)))
def residual_sums(spark, d):
    """What least squares promises: the train side's residuals are orthogonal to every input."""
    rows = features.with_split(training_rows(spark, d)).filter("is_train")
    model = least_squares.fit(rows, features.NUMERIC, features.levels_of(rows), features.TARGET)
    spread = features.one_hot(model.transform(rows).withColumns({"_zone": F.col("zone"), "_type": F.col("property_type")}))
    inputs = {"one": F.lit(1.0), **{c: F.col(c) for c in features.NUMERIC}, **{c: F.col(f"`{c}`") for c in _INPUTS if c not in ("one", *features.NUMERIC)}}
    rest = F.col(features.TARGET) - F.col("prediction")
    products = [F.struct(F.lit(name).alias("feature"), (F.sum(c * F.col(features.TARGET)) / F.count("id")).alias("product"),
                         (F.sum(c * rest) / F.count("id")).alias("residual")) for name, c in inputs.items()]
    return spread.agg(F.array(*products).alias("p")).select(F.inline("p")).select(
        "feature", F.round("product", 1).alias("mean_product"), (F.round(F.col("residual") / 1e6, 6) + F.lit(0.0)).alias("mean_residual_millions"))


@query("train_rf")
def train_rf(spark, d):
    return train.train_and_evaluate(training_rows(spark, d), SETTINGS, names=[train.FOREST]).evaluation


@query("train_gbt")
def train_gbt(spark, d):
    return train.train_and_evaluate(training_rows(spark, d), SETTINGS, names=[train.BOOSTING]).evaluation


@query("importances")
def importances(spark, d):
    trained = train.train_and_evaluate(training_rows(spark, d), SETTINGS, names=[train.FOREST])
    return metrics.importances_or_default(spark, trained.importances)


def inputs_of(spark, d):
    return raw(spark, d, "orders", RAW_HOMES).select("id", "area_sqm", "bedrooms", "bathrooms", "floor", "zone", "property_type", "has_bts")


# Inputs as they are scored: completed, and 0 days old.
_ASKED = f"""(SELECT -1 - id AS id, coalesce(area_sqm, 50) AS area_sqm, coalesce(bedrooms, 1) AS bedrooms, coalesce(bathrooms, 1) AS bathrooms,
    coalesce(floor, 1) AS floor, coalesce(has_bts, 0) AS has_bts, 0 AS age_days, coalesce(zone, 'CBD') AS zone,
    coalesce(property_type, 'คอนโด') AS property_type, 0.0 AS price_thb, FALSE AS is_train, 0.0 AS y FROM {raw_sql('orders', RAW_HOMES)})"""
_SCORE_FIT, _SCORED = least_squares_sql(f"(SELECT * FROM {_SPLIT} UNION ALL BY NAME SELECT * FROM {_ASKED})", _INPUTS)


@query("batch_score", f"""
    WITH {_SCORE_FIT}, fit AS (SELECT 1 - sum(r * r) / (count(*) * var_pop(y)) AS r2 FROM {_SCORED} WHERE NOT is_train AND id >= 0),
    s AS (SELECT -1 - t.id AS id, a.area_sqm, a.zone, -r AS price FROM {_SCORED} t JOIN {_ASKED} a USING (id))
    SELECT id, area_sqm, zone, round(price) AS predicted_price, {price_text_sql('price')} AS formatted_price,
           'Linear Regression (R² = ' || printf('%.4f', (SELECT r2 FROM fit)) || ')' AS model_info FROM s""")
def batch_score(spark, d):
    """Every row scored by the linear model of all inputs."""
    trained = train.train_and_evaluate(training_rows(spark, d), SETTINGS, names=[train.LINEAR])
    rows = train.score(inputs_of(spark, d), trained.model, trained.evaluation)
    return rows.withColumn("predicted_price", F.round("predicted_price", 0)).select(
        "id", "area_sqm", "zone", "predicted_price", "formatted_price", "model_info")


@query("batch_score_best")
def batch_score_best(spark, d):
    """Every row scored by the best of the three models."""
    trained = train.train_and_evaluate(training_rows(spark, d), SETTINGS)
    return train.score(inputs_of(spark, d), trained.model, trained.evaluation).select("id", "area_sqm", "zone", "predicted_price", "formatted_price", "model_info")


# Prices as they were found, a tenth of them missing.
RAW_OBSERVED = {**RAW_HOMES, "price_thb": f"CASE WHEN o_orderkey % 10 = 7 THEN NULL ELSE {RAW_HOMES['price_thb']} END", "price_imputed": "o_orderkey % 10 = 7"}
_LEAK_FREE = f"""
    found AS (SELECT *, price_thb IS NOT NULL AS observed, {SLOT_SQL.format(k='id')} < 8 AS is_train FROM {raw_sql('orders', RAW_OBSERVED)}),
    medians AS (SELECT property_type, zone, median(price_thb) AS med FROM found WHERE is_train GROUP BY ALL),
    grouped AS (SELECT found.* EXCLUDE (price_thb), coalesce(price_thb, med) AS price0 FROM found LEFT JOIN medians USING (property_type, zone)),
    filled AS (SELECT *, coalesce(price0, (SELECT median(price0) FROM grouped WHERE is_train)) AS price_thb FROM grouped),
    top AS (SELECT quantile_cont(price_thb / area_sqm, 0.99) AS p99 FROM filled WHERE is_train AND area_sqm > 0 AND price_thb / area_sqm > 0),
    kept AS (SELECT id, area_sqm, coalesce(bedrooms, 1) AS bedrooms, coalesce(bathrooms, 1) AS bathrooms,
        CASE WHEN property_type = 'ที่ดิน' THEN 0 ELSE coalesce(floor, 1) END AS floor, has_bts, coalesce(age_days, 0) AS age_days, zone, property_type,
        price_thb AS y, is_train FROM filled WHERE area_sqm > 0 AND price_thb / area_sqm > 0 AND price_thb / area_sqm <= (SELECT p99 FROM top) AND (is_train OR observed))"""
_FREE_FIT, _FREE = least_squares_sql("kept", _INPUTS)


@query("leak_free_training", f"""
    WITH {_LEAK_FREE}, {_FREE_FIT}, m AS ({_metrics_sql(_FREE)})
    SELECT m.*, (SELECT count(*) FROM kept WHERE is_train) AS train_rows, (SELECT count(*) FROM kept WHERE NOT is_train) AS test_rows,
           round((SELECT p99 FROM top), 4) AS price_limit FROM m""")
def leak_free_training(spark, d):
    """Cleaning learned on the train side; the models measured on prices that were observed."""
    rows, learned = fitted.training_rows(raw(spark, d, "orders", RAW_OBSERVED))
    sides = rows.agg(F.count_if("is_train"), F.count_if(~F.col("is_train"))).first()
    evaluation = train.train_and_evaluate(features.training_table(rows), SETTINGS, names=[train.LINEAR], levels_from_train=True).evaluation
    return _rounded(evaluation).withColumns({"train_rows": F.lit(sides[0]).cast("bigint"), "test_rows": F.lit(sides[1]).cast("bigint"),
                                             "price_limit": F.round(F.lit(learned.limit), 4)})


# On one input of two values, least squares, one unsampled tree and one boosting round all predict a group's mean.
_ONE_INPUT = f"""
    WITH x AS (SELECT *, {SLOT_SQL.format(k='id')} < 8 AS is_train FROM {_TRAINING}),
    g AS (SELECT has_bts, avg(price_thb) AS p FROM x WHERE is_train GROUP BY 1),
    s AS (SELECT price_thb AS y, p FROM x JOIN g USING (has_bts) WHERE NOT is_train)"""
ONE_TREE = train.ModelSettings(forest_trees=1, boosting_rounds=1, boosting_depth=1, bootstrap=False)


@query("models_one_input", _ONE_INPUT + """
    , e AS (SELECT round(avg(abs(p - y)), 2) AS MAE, round(sqrt(avg((p - y) * (p - y))), 2) AS RMSE,
                   round(1 - sum((p - y) * (p - y)) / (count(*) * var_pop(y)), 8) AS R2 FROM s)
    SELECT m.model, m.rank, MAE, RMSE, R2
    FROM e, (VALUES ('Linear Regression', 0), ('Random Forest', 1), ('Gradient Boosting', 2)) m(model, rank)""")
def models_one_input(spark, d):
    return _rounded(train.train_and_evaluate(training_rows(spark, d), ONE_TREE, numeric=["has_bts"], categorical=[]).evaluation)


# On three inputs of two values, trees of depth 3 end in the groups of all three, so every tree of a forest without
# sampling predicts the groups' means, and so does boosting after any number of rounds, as nothing is left to correct.
_THREE = {"one": "1", "has_bts": "has_bts", "land": "CASE WHEN property_type = 'ที่ดิน' THEN 1 ELSE 0 END", "large": "CASE WHEN area_sqm >= 110 THEN 1 ELSE 0 END"}
_THREE_FIT, _THREE_LEFT = least_squares_sql(_SPLIT, _THREE)
TREES = train.ModelSettings(forest_trees=5, forest_depth=3, boosting_rounds=12, boosting_depth=3, bootstrap=False)


def three_inputs(spark, d):
    return training_rows(spark, d).withColumns({"land": (F.col("property_type") == fixed.LAND).cast("double"), "large": (F.col("area_sqm") >= 110).cast("double")})


@query("models_three_inputs", f"""
    WITH {_THREE_FIT},
    g AS (SELECT c1, c2, c3, avg(y) AS p FROM t0 WHERE is_train GROUP BY ALL),
    s AS (SELECT y, p FROM t0 JOIN g USING (c1, c2, c3) WHERE NOT is_train),
    e AS (SELECT round(avg(abs(p - y)), 2) AS MAE, round(sqrt(avg((p - y) * (p - y))), 2) AS RMSE,
                 round(1 - sum((p - y) * (p - y)) / (count(*) * var_pop(y)), 8) AS R2 FROM s)
    {_metrics_sql(_THREE_LEFT)} UNION ALL
    SELECT m.model, m.rank, MAE, RMSE, R2 FROM e, (VALUES ('Random Forest', 1), ('Gradient Boosting', 2)) m(model, rank)""")
def models_three_inputs(spark, d):
    """Least squares, five trees and twelve rounds, each with predictions that SQL states."""
    return _rounded(train.train_and_evaluate(three_inputs(spark, d), TREES, numeric=["has_bts", "land", "large"], categorical=[]).evaluation)


@query("importances_three_inputs", f"""
    WITH x AS (SELECT [has_bts, {_THREE['land']}, {_THREE['large']}] AS c, y FROM {_SPLIT} WHERE is_train),
    g AS (SELECT c, count(*) AS n, sum(y) AS s, sum(y * y) AS q FROM x GROUP BY c),
    f AS (SELECT unnest([1, 2, 3]) AS f),
    -- What a split takes off the sum of squares of a node: the whole, then either side of the first split, then of the second.
    one AS (SELECT f, (SELECT sum(q) - sum(s) * sum(s) / sum(n) FROM g) - sum(part) AS gain FROM
        (SELECT f, c[f] AS v, sum(q) - sum(s) * sum(s) / sum(n) AS part FROM g, f GROUP BY ALL) GROUP BY f QUALIFY row_number() OVER (ORDER BY gain DESC, f) = 1),
    two AS (SELECT f1, v1, f, whole - sum(part) AS gain FROM
        (SELECT one.f AS f1, c[one.f] AS v1, f.f, c[f.f] AS v, sum(q) - sum(s) * sum(s) / sum(n) AS part FROM g, one, f WHERE f.f <> one.f GROUP BY ALL)
        JOIN (SELECT c[one.f] AS v1, sum(q) - sum(s) * sum(s) / sum(n) AS whole FROM g, one GROUP BY ALL) USING (v1)
        GROUP BY f1, v1, f, whole QUALIFY row_number() OVER (PARTITION BY v1 ORDER BY gain DESC, f) = 1),
    three AS (SELECT 6 - f1 - f AS f, (sum(q) - sum(s) * sum(s) / sum(n)) - sum(q - s * s / n) AS gain FROM g JOIN two ON c[f1] = v1 GROUP BY f1, v1, f, c[f]),
    every AS (SELECT f, gain FROM one UNION ALL SELECT f, gain FROM two UNION ALL SELECT f, gain FROM three)
    SELECT ['has_bts', 'land', 'large'][f] AS feature, round_even(sum(gain) / (SELECT sum(gain) FROM every) * 10000, 0) / 10000 AS importance FROM every GROUP BY f""")
def importances_three_inputs(spark, d):
    """What each input takes off the squared error of a forest's trees."""
    trained = train.train_and_evaluate(three_inputs(spark, d), TREES, names=[train.FOREST], numeric=["has_bts", "land", "large"], categorical=[])
    return metrics.importances_or_default(spark, trained.importances)


@query("importances_one_input", "SELECT 'has_bts' AS feature, 1.0::DOUBLE AS importance")
def importances_one_input(spark, d):
    trained = train.train_and_evaluate(training_rows(spark, d), ONE_TREE, names=[train.FOREST], numeric=["has_bts"], categorical=[])
    return metrics.importances_or_default(spark, trained.importances)


@query("rule_score", f"""
    SELECT id, round(coalesce(area_sqm, 50) * CASE property_type WHEN 'คอนโด' THEN 120000 WHEN 'บ้านเดี่ยว' THEN 80000
        WHEN 'ทาวน์โฮม' THEN 70000 WHEN 'ที่ดิน' THEN 50000 ELSE 80000 END * CASE zone WHEN 'CBD' THEN 1.5
        WHEN 'Inner City' THEN 1.2 WHEN 'Suburban' THEN 0.9 WHEN 'Outer' THEN 0.7 ELSE 1.0 END
        * CASE WHEN has_bts <> 0 THEN 1.1 ELSE 1.0 END, 2)::DOUBLE AS predicted_price,
        '{fixed.ESTIMATE_LABEL}' AS model_info FROM {raw_sql('orders', RAW_HOMES)}""")
def rule_score(spark, d):
    inputs = raw(spark, d, "orders", RAW_HOMES).select("id", "area_sqm", "property_type", "zone", "has_bts")
    return train.score(inputs, None).select("id", F.round("predicted_price", 2).alias("predicted_price"), "model_info")
