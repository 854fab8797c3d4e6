"""Spark ML layer: preprocessing semantics, selection, scoring, persistence."""

import os

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from panelforge.operators import features as FE
from panelforge.operators import ml as ML


def _toy(spark, n=400):
    df = spark.range(n).select(
        (F.col("id") % 10).cast("double").alias("a"),
        F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 13).cast("double")).alias("b"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("c"),
    ).withColumn("label", ((F.col("a") > 4).cast("int") + (F.col("c") == "x").cast("int")).cast("int"))
    return FE.FeatureSet(df, ["a", "b"], ["c"], class_labels=["p", "q", "r"])


def test_exact_median_imputation(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (None,)], "x double")
    assert ML.exact_medians(df, ["x"]) == {"x": 2.5}


def test_unseen_category_is_zero_vector(spark):
    fs = _toy(spark)
    stages, _ = ML.build_preprocessor(fs.df, fs.numeric, fs.categorical)
    model = Pipeline(stages=stages).fit(fs.df)
    new = spark.createDataFrame([(1.0, None, "zzz")], "a double, b double, c string")
    vec = model.transform(new).first().features.toArray().tolist()
    assert vec[:2] == [1.0, ML.exact_medians(fs.df, ["b"])["b"]]
    assert vec[2:] == [0.0, 0.0]


def test_select_and_predict(spark, tmpdir_path):
    fs = _toy(spark)
    train, test = fs.df.where("a != 3"), fs.df.where("a = 3")
    best, ranked = ML.select_model(fs, train, test, "classification", tuning=False)
    assert len(ranked) == 3 and best.metrics["f1_macro"] >= ranked[-1].metrics["f1_macro"]
    scored = ML.predict(best.model, test, "classification", fs.class_labels).collect()
    for r in scored:
        assert r.prediccion in fs.class_labels
        assert sum(r.probabilidades.values()) == pytest.approx(1.0)
    path = os.path.join(tmpdir_path, "model")
    ML.save_model(best.model, path)
    assert ML.load_model(path).transform(test).count() == test.count()
    with pytest.raises(FileNotFoundError):
        ML.load_model(os.path.join(tmpdir_path, "none"))


def test_tuned_search_with_folds(spark):
    fs = _toy(spark, 300)
    from panelforge.operators import splits as H

    train = H.hash_folds(fs.df.withColumn("k", F.monotonically_increasing_id()), ["a", "b", "c"])
    tree = ML.candidates("classification", 3)[0]
    f = ML.fit_candidate(tree, fs, train, fs.df, "classification", tuning=True, n_iter=2)
    assert f.cv_score is not None and 0 <= f.cv_score <= 1


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "label int")
    w = {r.label: (r.w_one, r.w_balanced, r.w_positive) for r in ML.with_class_weights(df).distinct().collect()}
    assert w == {0: (1.0, pytest.approx(4 / 6), 1.0), 1: (1.0, pytest.approx(2.0), pytest.approx(3.0))}


def test_medians_are_of_the_rows_fitted_on(spark):
    df = spark.createDataFrame([(1.0, 0), (3.0, 0), (100.0, 1), (None, 1)], "x double, fold int")
    imputer = ML.MedianImputer(["x"])
    part, whole = imputer.fit(df.where("fold = 0")), imputer.fit(df)
    missing = df.where("x IS NULL")
    assert part.transform(missing).first()["x__imp"] == 2.0 and whole.transform(missing).first()["x__imp"] == 3.0


def test_search_maps_and_weights(spark):
    boosted = ML.candidates("classification", 2)[2]
    m = {p.name: v for p, v in boosted.param_map({"maxIter": 7}, "classification").items()}
    assert m == {"maxIter": 7, "weightCol": "w_positive"}
    tree = ML.candidates("classification", 2)[0]
    assert {p.name: v for p, v in tree.param_map({"balanced": True}, "classification").items()} == {"weightCol": "w_balanced"}
    forest = ML.candidates("regression")[1]
    assert ML.MAX_DEPTH in forest.space["maxDepth"] and "balanced" not in forest.space


def test_selection_follows_the_cross_validation(spark, monkeypatch):
    scores = {"decision_tree": (0.9, 0.1), "random_forest": (0.5, 0.8), "boosted": (0.7, 0.9)}
    monkeypatch.setattr(ML, "fit_candidate", lambda c, *a, **k: ML.Fitted(c.name, None, {}, scores[c.name][0], {"f1_macro": scores[c.name][1]}))
    fs = _toy(spark)
    best, _ = ML.select_model(fs, fs.df, fs.df, "classification", tuning=True)
    assert best.algorithm == "decision_tree"
    best, _ = ML.select_model(fs, fs.df, fs.df, "classification", tuning=True, select_on="test")
    assert best.algorithm == "boosted"


def test_time_folds_score_every_map(spark):
    import datetime as dt

    from panelforge.operators import splits as H

    day = F.date_add(F.lit(dt.date(2025, 1, 1)), (F.col("a") * 3).cast("int"))
    fs = FE.FeatureSet(_toy(spark, 300).df.withColumn("split_date", day), ["a", "b"], ["c"], date="split_date", class_labels=["p", "q", "r"])
    folds = H.expanding_folds(fs.df, "split_date", 3)
    tree = ML.candidates("classification", 3)[0]
    f = ML.fit_candidate(tree, fs, fs.df, fs.df, "classification", tuning=True, n_iter=2, time_bounds=ML.time_fold_bounds(folds))
    assert 0 <= f.cv_score <= 1


def test_train_registry_and_evaluate(spark, sf, tmpdir_path):
    from panelforge.plans import models as MOD
    from panelforge.sources import registry as REG

    tables = MOD.domain_tables(spark, sf)
    # a file:// path: what lies there must not depend on the driver's own disk functions
    reg_path, model_dir = "file://" + os.path.join(tmpdir_path, "registry"), os.path.join(tmpdir_path, "models")
    MOD.train(spark, tables, ["proyeccion_donaciones"], registry_path=reg_path, model_dir=model_dir)
    MOD.train(spark, tables, ["prioridad_atencion"], registry_path=reg_path, model_dir=model_dir)
    reg = REG.read_registry(spark, reg_path)
    names = {r.name for r in reg.collect()}
    assert names == {"proyeccion_donaciones", "prioridad_atencion"}
    entry = REG.lookup(reg, "prioridad_atencion")
    assert entry["class_labels"] == ["Bajo", "Medio", "Alto"] and "f1_macro" in entry["metrics"]
    assert "sexo" in entry["categorical_values"]
    ev = MOD.evaluate(spark, tables, "prioridad_atencion", model_dir)
    cm = ev["confusion"].collect()
    assert [r.real for r in sorted(cm, key=lambda r: r.pos)] == ["Real_Bajo", "Real_Medio", "Real_Alto"]
    assert sum(r.Pred_Bajo + r.Pred_Medio + r.Pred_Alto for r in cm) == entry["n_test"]
    assert set(entry["all_algorithms"]) == {"decision_tree", "random_forest", "boosted"}
    summary, reports = MOD.evaluate_all(spark, tables, reg, model_dir)
    assert summary.columns[:4] == ["modelo", "tarea", "algoritmo", "n_test"] and set(reports) == names
    rows = {r.modelo: r for r in summary.collect()}
    assert set(rows) == names
    one, other = rows["prioridad_atencion"], rows["proyeccion_donaciones"]
    assert (one.algoritmo, one.n_test) == (entry["selected_algorithm"], entry["n_test"])
    assert one.f1_macro == pytest.approx(entry["metrics"]["f1_macro"]) and one.mae is None
    assert other.tarea == "regression" and other.mae > 0 and other.f1_macro is None
    with pytest.raises(KeyError):
        MOD.evaluate_all(spark, tables, reg, model_dir, ["prioridad_atencion", "nope"])
    with pytest.raises(KeyError):
        MOD.spec("nope")


def test_triage_and_sparcs_builders(spark):
    rows = [(30 + i % 5, "F" if i % 2 else "M", f"c{i % 45}", i % 10, (i % 6) or None, "A") for i in range(200)]
    tri = spark.createDataFrame(rows, "age int, gender string, ChiefComplaint string, PainGrade int, TriageGrade int, AVPU string")
    for c in ["admission_month", "admission_weekday", "admission_hour", "CriticalStatus", "StuporStatus", "MentalDistress",
              "MaterialDistress", "BlooddpressurSystol", "BlooddpressurDiastol", "PulseRate", "RespiratoryRate", "O2Saturation"]:
        tri = tri.withColumn(c, F.lit(1.0))
    fs = FE.triage_features(tri)
    out = fs.df.collect()
    # grade 6 and NULL rows are dropped; complaints outside the top 40 become 'otros'
    assert len(out) == sum(1 for r in rows if r[4] in (1, 2, 3, 4, 5))
    assert {r.label for r in out} <= {0, 1, 2} and "otros" in {r.motivo_consulta for r in out}
    sp = spark.createDataFrame([("120 +", "F"), (" 7 ", "M"), ("abc", "F")], "length_of_stay string, gender string")
    for c in FE.SPARCS_CAT + FE.SPARCS_NUM:
        if c not in sp.columns:
            sp = sp.withColumn(c, F.lit("x"))
    got = sorted(r.label for r in FE.sparcs_features(sp).df.collect())
    assert got == [7.0, 120.0]


def test_one_vs_rest_probabilities(spark):
    from pyspark.ml.classification import GBTClassifier, OneVsRest

    fs = _toy(spark)
    stages, _ = ML.build_preprocessor(fs.df, fs.numeric, fs.categorical)
    ovr = OneVsRest(classifier=GBTClassifier(maxIter=5, seed=ML.SEED), labelCol="label")
    model = Pipeline(stages=stages + [ovr]).fit(fs.df)
    rows = ML.predict(model, fs.df, "classification", fs.class_labels).collect()
    for r in rows[:50]:
        probs = r.probabilidades
        assert sum(probs.values()) == pytest.approx(1.0)
        assert r.prediccion == fs.class_labels[r.clase_indice]
        assert max(probs, key=probs.get) == r.prediccion


def test_feature_importance_top_n(spark):
    fs = _toy(spark)
    stages, _ = ML.build_preprocessor(fs.df, fs.numeric, fs.categorical)
    model = Pipeline(stages=stages + [DecisionTreeClassifier(labelCol="label", seed=ML.SEED)]).fit(fs.df)
    imp = ML.feature_importance(spark, model, top_n=2).collect()
    assert len(imp) == 2 and imp[0].importancia >= imp[1].importancia
    names = {r.variable for r in ML.feature_importance(spark, model).collect()}
    assert names == {"a", "b", "c_x", "c_y"}


def test_optional_csv_to_features(spark, tmpdir_path):
    from panelforge.sources import files as S

    raw = ["age", "gender", "ChiefComplaint", "PainGrade", "TriageGrade", "AVPU", "admission_month", "admission_weekday",
           "admission_hour", "CriticalStatus", "StuporStatus", "MentalDistress", "MaterialDistress", "BlooddpressurSystol",
           "BlooddpressurDiastol", "PulseRate", "RespiratoryRate", "O2Saturation"]
    path = os.path.join(tmpdir_path, "triage.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(raw) + "\n")
        for grade in ("2.0", "3", "", "2.5", "x", "9"):
            f.write(",".join(["31.5", "F", "fever", "", grade, "A", *["1"] * 12]) + "\n")
    fs = FE.triage_features(S.load_optional(spark, "triage", path))
    assert dict(fs.df.dtypes)["edad"] == "double"
    assert sorted(r.label for r in fs.df.collect()) == [1, 2]
    empty = os.path.join(tmpdir_path, "empty.csv")
    with open(empty, "w", encoding="utf-8") as f:
        f.write(",".join(raw) + "\n")
    with pytest.raises(S.InvalidTableError, match="no rows"):
        S.load_optional(spark, "triage", empty)


def test_features_are_what_was_declared(spark):
    df = spark.createDataFrame([(1.0, "x", 0)], "a double, c string, label int")
    with pytest.raises(FE.FeatureError) as e:
        FE.FeatureSet(df.withColumn("more", F.lit(1)), ["a", "b"], ["c"])
    assert e.value.problems == {"absent": ["b"], "undeclared": ["more"]}
    with pytest.raises(FE.FeatureError) as e:
        FE.FeatureSet(df, ["a"], ["c"], forbidden=["a", "z"])
    assert e.value.problems == {"forbidden": ["a"]}
    assert FE.FeatureSet(df, ["a"], ["c"]).features == ["a", "c"]
    assert {"length_of_stay", "apr_severity_of_illness"} <= set(FE.SPARCS_POST_DISCHARGE)
    empty = FE.FeatureSet(df.limit(0), ["a"], ["c"])
    with pytest.raises(ValueError, match="not enough history"):
        FE.assert_not_empty(empty, "m")


def test_signal_of_independent_numbers_is_small(spark):
    from panelforge.operators import profile as P

    df = spark.range(4000).select(F.rand(1).alias("x"), F.rand(2).alias("label"), F.col("id").cast("double").alias("n"))
    df = df.withColumn("twice", F.col("label") * 2)
    got = {r.variable: r.mutual_information for r in P.mutual_information(df, "label", ["x", "n", "twice"], [], regression=True).collect()}
    assert got["x"] < 0.05 and got["n"] < 0.05
    assert got["twice"] == pytest.approx(2.302, abs=0.02)


def test_untuned_trees_and_forests_have_no_depth_of_five(spark):
    from panelforge.operators import ml

    for task in ("classification", "regression"):
        depth = {c.name: c.untuned.get("maxDepth") for c in ml.candidates(task)}
        assert depth == {"decision_tree": 30, "random_forest": 30, "boosted": None}


def test_importances_of_any_model(spark):
    """Several classes: own importances, the mean over a one-vs-rest, and permutation."""
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest

    fs = _toy(spark)
    df = fs.df.withColumn("label", (F.col("a") > 4).cast("int") + (F.col("a") > 7).cast("int"))
    stages, _ = ML.build_preprocessor(df, fs.numeric, fs.categorical)
    last = [ML.SoftmaxBooster(maxIter=2, maxDepth=2, classes=3), OneVsRest(classifier=GBTClassifier(maxIter=2), labelCol="label"), LogisticRegression(labelCol="label")]
    for est in last:
        model = Pipeline(stages=[*stages, est]).fit(df)
        perm = {r.variable: r.importancia for r in ML.permutation_importance(model, df, ["a", "b", "c"], "classification").collect()}
        assert set(perm) == {"a", "b", "c"} and max(perm, key=perm.get) == "a" and perm["a"] > 0.2
        if isinstance(est, LogisticRegression):
            with pytest.raises(ValueError, match="permutation_importance"):
                ML.feature_importance(spark, model)
        else:
            imp = ML.feature_importance(spark, model).collect()
            assert imp[0].variable == "a" and sum(r.importancia for r in imp) == pytest.approx(1.0)


def test_boosted_candidate_of_three_classes(spark):
    cand = ML.candidates("classification", 3)[2]
    assert isinstance(cand.estimator, ML.SoftmaxBooster) and {"columnRate", "minChildWeight"} <= set(cand.space)
    drawn = ML.draw_params(cand.space, 3)
    maps = [{p.name: v for p, v in cand.param_map(d, "classification").items()} for d in drawn]
    assert {m["weightCol"] for m in maps} <= {"w_balanced", "w_one"} and all(0.7 <= m["columnRate"] <= 1 for m in maps)


def test_a_broken_model_is_not_a_missing_one(tmpdir_path, spark):
    os.makedirs(os.path.join(tmpdir_path, "broken", "metadata"))
    with pytest.raises(Exception) as e:
        ML.load_model(os.path.join(tmpdir_path, "broken"))
    assert not isinstance(e.value, FileNotFoundError)
