import numpy as np
import pytest
from pyspark.sql import functions as F

from plotwise.operators import features, least_squares
from plotwise.plans import fitted, train

SMALL = train.ModelSettings(forest_trees=8, forest_depth=6, boosting_rounds=8)


@pytest.fixture(scope="module")
def homes(spark):
    k = F.col("id")
    zone = F.element_at(F.array(*map(F.lit, ["CBD", "Outer"])), (k % 2 + 1).cast("int"))
    kind = F.element_at(F.array(*map(F.lit, ["คอนโด", "ที่ดิน", "บ้านเดี่ยว"])), (k % 3 + 1).cast("int"))
    area = (k * 37 % 180 + 20).cast("double")
    price = area * 100000 * F.when(zone == "CBD", 1.5).otherwise(0.7) * (1 + (k * 13 % 11) / 100.0)
    return spark.range(1500).select(
        k.cast("string").alias("id"), area.alias("area_sqm"), (k % 4).cast("double").alias("bedrooms"),
        F.when(k % 7 != 0, 1.0).alias("bathrooms"), (k % 30).cast("double").alias("floor"), zone.alias("zone"),
        kind.alias("property_type"), (k % 2).cast("int").alias("has_bts"), (k % 300).cast("int").alias("age_days"),
        F.when(k % 50 != 0, price).alias("price_thb"))


@pytest.fixture(scope="module")
def trained(homes):
    return train.train_and_evaluate(features.training_table(homes), SMALL)


def test_training_table(homes):
    rows = features.training_table(homes)
    assert rows.count() == 1470
    assert rows.filter("property_type = 'ที่ดิน' and floor <> 0").isEmpty()
    assert rows.filter("bathrooms is null").isEmpty()


def test_three_models_are_measured(trained):
    got = {r.model: r for r in trained.evaluation.collect()}
    assert set(got) == {train.LINEAR, train.FOREST, train.BOOSTING}
    assert all(r.MAE > 0 and r.RMSE >= r.MAE and 0.5 < r.R2 <= 1 for r in got.values())
    assert trained.best_name == max(got.values(), key=lambda r: r.R2).model


def test_feature_names_match_the_vector(homes):
    model = features.fit_features(features.training_table(homes))
    names = features.feature_names(model)
    assert names == [*features.NUMERIC, "zone_CBD", "zone_Outer", "property_type_คอนโด", "property_type_ที่ดิน",
                     "property_type_บ้านเดี่ยว"]
    unseen = homes.limit(1).withColumn("zone", F.lit("Moon")).fillna({"bathrooms": 1.0, "price_thb": 0.0})
    vector = model.transform(unseen).first()["features"].toArray()
    assert len(vector) == len(names) and vector[6:8].tolist() == [0.0, 0.0]


def test_save_load_and_score(spark, trained, tmp_path):
    path = str(tmp_path / "model")
    train.save_model(trained.model, path)
    inputs = spark.createDataFrame([(1, 50.0, "CBD", "คอนโด"), (2, None, "Moon", None)],
                                   "n int, area_sqm double, zone string, property_type string")
    rows = train.score(inputs, train.load_model(path), trained.evaluation).orderBy("n").collect()
    assert 1_000_000 < rows[0].predicted_price < 100_000_000
    assert rows[0].formatted_price.endswith(" ล้าน") and rows[0].model_info.startswith(trained.best_name + " (R² = 0.")
    assert rows[1].predicted_price is not None
    rule = train.score(inputs, None).orderBy("n").first()
    assert rule.predicted_price == 50 * 120000 * 1.5 and rule.model_info == "Estimated (model not loaded)"


def in_order(df, columns):
    parts = df.select(*columns).rdd.glom().collect()
    return len(parts), all(part == sorted(part) for part in parts)


def test_trees_grow_from_rows_in_order(homes, monkeypatch):
    monkeypatch.setattr(train, "PART_ROWS", 200)
    grown = train.train_and_evaluate(features.training_table(homes), SMALL, names=[train.FOREST])
    parts, ordered = in_order(grown.scored, [*features.CATEGORICAL, *features.NUMERIC, "id"])
    assert parts == 8 and ordered and grown.scored.count() + features.with_split(features.training_table(homes)).filter("is_train").count() == 1470


def test_trees_score_in_every_core_and_in_order(homes):
    forest = train.train_and_evaluate(features.training_table(homes), SMALL, names=[train.FOREST]).model
    inputs = homes.select("id", "area_sqm", "zone", "property_type").coalesce(1)
    scored = train.score(inputs, forest)
    assert in_order(scored, ["zone", "property_type", "area_sqm"]) == (8, True)
    want = forest.transform(train.complete_inputs(inputs)).select("id", "prediction").collect()
    assert sorted(map(tuple, scored.select("id", "predicted_price").collect())) == sorted(map(tuple, want))


def test_split_ignores_partitioning(homes):
    a = features.with_split(homes).filter("is_train").select("id")
    b = features.with_split(homes.repartition(7)).filter("is_train").select("id")
    assert a.exceptAll(b).isEmpty() and 0.75 < a.count() / 1500 < 0.85


def test_one_hot(homes):
    flat = features.one_hot(homes, {"zone": ["CBD", "Outer"]})
    assert flat.filter("zone_CBD + zone_Outer <> 1").isEmpty() and "zone" not in flat.columns


def test_linear_model_has_no_importances(homes):
    linear = train.train_and_evaluate(features.training_table(homes), SMALL, names=[train.LINEAR])
    assert linear.importances is None


def test_importances_cover_every_feature(homes):
    forest = train.train_and_evaluate(features.training_table(homes), SMALL, names=[train.FOREST])
    rows = {r.feature: r.importance for r in forest.importances.collect()}
    assert sum(rows.values()) == pytest.approx(1) and max(rows, key=rows.get) == "area_sqm" and len(rows) == 11


def test_least_squares_equals_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(rng.normal()), float(i % 7), 1.0, ["a", "b", "c", None][i % 4], ["x", "y"][i % 2]) for i in range(200)]
    y = [3 * r[1] - r[2] + {"a": 5, "b": -1, "c": 2, None: 0}[r[4]] + float(rng.normal()) for r in rows]
    df = spark.createDataFrame([(*r, v) for r, v in zip(rows, y)], "id long, u double, v double, one double, p string, q string, y double")
    levels = {"p": ["a", "b", "c"], "q": ["x", "y"]}
    model = least_squares.fit(df, ["u", "v", "one"], levels, "y")
    x = np.array([[r[1], r[2], r[3], *[float(r[4] == v) for v in "abc"], *[float(r[5] == v) for v in "xy"]] for r in rows])
    centred = x - x.mean(axis=0)
    want = np.linalg.lstsq(centred, np.array(y) - np.mean(y), rcond=1e-10)[0]
    got = [*model.numeric.values(), *[w for c in levels for w in model.levels[c].values()]]
    assert got == pytest.approx(want.tolist(), abs=1e-8)
    predicted = [r["prediction"] for r in model.transform(df).orderBy("id").collect()]
    assert predicted == pytest.approx((centred @ want + np.mean(y)).tolist(), abs=1e-8)


def test_least_squares_of_few_rows(spark):
    df = spark.createDataFrame([(1.0, "a", 4.0)], "u double, p string, y double")
    model = least_squares.fit(df, ["u"], {"p": ["a", "b"]}, "y")
    assert model.transform(df).first()["prediction"] == pytest.approx(4.0)
    assert model.transform(df.withColumn("p", F.lit("never seen"))).first()["prediction"] == pytest.approx(4.0)
    assert least_squares.fit(df.limit(0), ["u"], {"p": ["a"]}, "y").transform(df).first()["prediction"] == 0


def test_linear_model_is_saved_and_scored(spark, homes, tmp_path):
    trained = train.train_and_evaluate(features.training_table(homes), names=[train.LINEAR])
    train.save_model(trained.model, str(tmp_path / "model"))
    loaded = train.load_model(str(tmp_path / "model"))
    inputs = homes.select("id", "area_sqm", "zone", "property_type")
    a, b = (train.score(inputs, m, trained.evaluation).orderBy("id").collect() for m in (trained.model, loaded))
    assert a == b and a[0].model_info.startswith("Linear Regression (R² = 0.")


def test_leak_free_cleaning_ignores_test_rows(spark, homes, tmp_path):
    typed = homes.withColumn("price_imputed", F.col("price_thb").isNull())
    sides = features.with_split(typed)
    rows, learned = fitted.training_rows(typed)
    absurd = typed.join(sides.select("id", "is_train"), "id").withColumn(
        "price_thb", F.when(F.col("is_train"), F.col("price_thb")).otherwise(F.col("price_thb") * 1000)).drop("is_train")
    _, again = fitted.training_rows(absurd)
    assert learned.limit == again.limit and learned.median == again.median
    assert sorted(map(tuple, learned.medians.collect())) == sorted(map(tuple, again.medians.collect()))
    test = rows.filter("not is_train")
    assert test.filter("not observed").isEmpty() and test.count() > 0
    assert rows.filter("is_train and not observed").count() > 0
    learned.save(spark, str(tmp_path / "fitted"))
    loaded = fitted.FittedCleaning.load(spark, str(tmp_path / "fitted"))
    assert (loaded.median, loaded.limit, loaded.levels) == (learned.median, learned.limit, learned.levels)
    one = spark.createDataFrame([("CBD", "คอนโด", None, 50.0)], "zone string, property_type string, price_thb double, area_sqm double")
    assert loaded.filled(one).first()["price_thb"] == learned.filled(one).first()["price_thb"] > 0


def test_levels_of_the_test_side_stay_unknown(homes):
    rows = features.training_table(homes)
    only_test = features.with_split(rows).withColumn("zone", F.when(F.col("is_train"), F.col("zone")).otherwise(F.lit("Elsewhere"))).drop("is_train")
    trained = train.train_and_evaluate(only_test, SMALL, names=[train.LINEAR], levels_from_train=True)
    assert set(trained.model.levels["zone"]) == {"CBD", "Outer"}


def test_no_part_grows_with_the_table():
    most, least = train.MOST_ROWS, train.PART_ROWS
    assert train.parts_for(100 * most, have=3, cores=12) == 100 and train.parts_for(4 * most, have=3, cores=12) == 12
    assert train.parts_for(10 * least, have=3, cores=12) == 10 and train.parts_for(1, have=8, cores=8) == 1 and train.parts_for(0, 4, 8) == 1
    assert train.parts_for(50 * least, have=30, cores=8) == 30


def test_passes_end_in_a_whole_turn():
    assert [train.whole_turns(p, 12) for p in (1, 8, 12, 13, 18, 24, 100)] == [1, 8, 12, 24, 24, 24, 108]


def test_trees_grow_from_even_parts(homes, monkeypatch):
    monkeypatch.setattr(train, "PART_ROWS", 20)
    uneven = features.training_table(homes.filter("id >= 1320 or id % 50 = 1"))
    grown = train.train_and_evaluate(uneven, SMALL, names=[train.FOREST])
    sides = features.with_split(uneven)
    sizes = [len(part) for part in grown.scored.select("id").rdd.glom().collect()]
    assert uneven.rdd.getNumPartitions() == len(sizes) == 8 and sum(sizes) == sides.filter("not is_train").count() > 20
    assert max(sizes) < sum(sizes) / 2


def test_more_parts_than_cores_fill_every_turn(homes, monkeypatch):
    monkeypatch.setattr(train, "MOST_ROWS", 150)
    monkeypatch.setattr(train, "PART_ROWS", 100)
    table = features.training_table(homes)
    assert train.parts_for(table.count(), 8, 8) == 10
    assert train.train_and_evaluate(table, SMALL, names=[train.BOOSTING]).scored.rdd.getNumPartitions() == 16
