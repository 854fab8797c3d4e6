"""Model queries (M*, A27, A28): fits have no SQL twin, so rows-only checks
here and invariant tests in tests/test_ml.py."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import ml as ML
from ..operators import splits as H
from ..operators.boosting import SoftmaxBooster
from ..operators.joins import attach_row
from ..session import cut_lineage
from . import oracle as O
from . import roles
from .q_misc import lehmer_sql
from .registry import normalise, query


def _stock7(spark, sf):
    fs = FE.stock_features(roles.consumo(spark, sf), roles.catalogue(spark, sf), 7, items_unique=True)
    split = H.temporal_split(fs.df, "split_date")
    return fs, split.where("split = 'train'").drop("split", "cutoff"), split.where("split = 'test'").drop("split", "cutoff")


@query("m8_model_selection", None, note="three candidates, no tuning (M7), temporal split (H3), ranked by macro F1 (T4)")
def m8_model_selection(spark, sf):
    fs, train, test = _stock7(spark, sf)
    # reused by three fits: cut the lineage into the shared checkpoint folder
    train, test = cut_lineage(train), cut_lineage(test)
    best, ranked = ML.select_model(fs, train, test, "classification", tuning=False)
    out = ML.comparison_frame(spark, ranked)
    return normalise(out, [c for c in out.columns if c not in ("algoritmo", "mejores_hiperparametros")], 4)


def _priority_tree(spark, sf):
    """Decision tree on the priority features; rows split by a hash of the row id."""
    p = roles.pacientes(spark, sf).withColumn("k", F.col("paciente_id").cast("long"))
    fs = FE.priority_features(p, keys=["k"])
    split = H.hash_split(cut_lineage(fs.df), fs.keys, method="lehmer")
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    stages, _ = ML.build_preprocessor(train, fs.numeric, fs.categorical)
    tree = DecisionTreeClassifier(seed=ML.SEED, maxDepth=6, labelCol="label", maxBins=ML.MAX_BINS)
    return fs, train, test, Pipeline(stages=[*stages, tree]).fit(train)


@query("m11_batch_scoring", None, note="decision tree on the priority features, hash split, scored test rows with label + probabilities")
def m11_batch_scoring(spark, sf):
    fs, _, test, model = _priority_tree(spark, sf)
    scored = ML.predict(model, test, "classification", fs.class_labels)
    return scored.select("label", "prediccion", "clase_indice", F.map_values("probabilidades").alias("probs"))


PRIORITY_LABEL = "CASE nivel_prioridad_atencion WHEN 'Bajo' THEN 0 WHEN 'Medio' THEN 1 WHEN 'Alto' THEN 2 END"
SPLIT_SQL = f"""
, s AS (SELECT *, CAST({PRIORITY_LABEL} AS INTEGER) AS label,
          CASE WHEN {lehmer_sql('CAST(paciente_id AS BIGINT)')} % 10000 < 2000 THEN 'test' ELSE 'train' END AS split
        FROM pacientes WHERE nivel_prioridad_atencion IS NOT NULL)"""


@query(
    "m11_scored_counts",
    O.with_(O.PACIENTES) + SPLIT_SQL + """
SELECT label, COUNT(*) AS n_rows, COUNT(*) AS n_named, COUNT(*) AS n_probabilities FROM s WHERE split = 'test' GROUP BY label""",
    note="what must hold of any scored test side: its rows by class, a label from the list, probabilities that sum to 1",
)
def m11_scored_counts(spark, sf):
    fs, _, test, model = _priority_tree(spark, sf)
    scored = ML.predict(model, test, "classification", fs.class_labels)
    total = F.aggregate(F.map_values("probabilidades"), F.lit(0.0), lambda a, x: a + x)
    count = lambda cond: F.sum(cond.cast("long"))
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"),
        count(F.col("prediccion").isin(*fs.class_labels)).alias("n_named"),
        count((F.abs(total - 1) < 1e-9) & (F.size("probabilidades") == len(fs.class_labels))).alias("n_probabilities"),
    )


def _slots_sql() -> str:
    numbers = " UNION ALL ".join(f"SELECT '{c}' AS variable" for c in FE.PRIORITY_NUM)
    texts = " UNION ".join(
        f"SELECT '{c}_' || COALESCE(CAST({c} AS VARCHAR), 'desconocido') AS variable FROM s WHERE split = 'train'" for c in FE.CLINICAL_CAT
    )
    return O.with_(O.PACIENTES) + SPLIT_SQL + f"""
SELECT variable, CAST(1 AS DOUBLE) AS total FROM ({numbers} UNION ALL ({texts})) t"""


@query("a27_slot_names", _slots_sql(), note="names of the encoded slots; their importances sum to 1")
def a27_slot_names(spark, sf):
    _, _, _, model = _priority_tree(spark, sf)
    imp = ML.feature_importance(spark, model)
    return attach_row(imp.select("variable"), imp.agg(F.round(F.sum("importancia"), 9).alias("total")))


def _m1_sql() -> str:
    numbers = " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {O.R(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 9)} AS value FROM s WHERE split = 'train'"
        for c in FE.CLINICAL_BASE_NUM
    )
    texts = " UNION ALL ".join(
        f"SELECT '{c}', CAST(COUNT(DISTINCT COALESCE(CAST({c} AS VARCHAR), 'desconocido')) AS DOUBLE) FROM s WHERE split = 'train'"
        for c in FE.CLINICAL_CAT
    )
    return O.with_(O.PACIENTES) + SPLIT_SQL + f"\n{numbers} UNION ALL {texts}"


@query("m1_medians_and_slots", _m1_sql(), note="imputation medians and one-hot slots that the preprocessor takes from the training side")
def m1_medians_and_slots(spark, sf):
    _, train, _, model = _priority_tree(spark, sf)
    medians = ML.exact_medians(train, FE.CLINICAL_BASE_NUM)
    slots = {
        c: float(len(v)) for st in model.stages if hasattr(st, "labelsArray") for c, v in zip(st.getInputCols(), st.labelsArray, strict=True)
    }
    rows = spark.createDataFrame([*medians.items(), *slots.items()], "variable string, value double")
    return normalise(rows, ["value"], 9)


@query(
    "m5_class_weights",
    O.with_(O.PACIENTES) + SPLIT_SQL + f"""
SELECT label, COUNT(*) AS n, {O.R('(SELECT COUNT(*) FROM s) / ((SELECT COUNT(DISTINCT label) FROM s) * CAST(COUNT(*) AS DOUBLE))')} AS w_balanced
FROM s GROUP BY label""",
    note="balanced weights n / (k * n_class)",
)
def m5_class_weights(spark, sf):
    fs = FE.priority_features(roles.pacientes(spark, sf))
    w = ML.with_class_weights(fs.df.select("label"))
    return normalise(w.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("w_balanced").alias("w_balanced")), ["w_balanced"])


@query("a27_feature_importance", None, note="tree importances per encoded slot, one-hot slots named by value, sorted")
def a27_feature_importance(spark, sf):
    _, _, _, model = _priority_tree(spark, sf)
    return ML.feature_importance(spark, model)


@query("a27_permutation_importance", None, note="macro F1 lost on the test side when a column's values are permuted, for any model")
def a27_permutation_importance(spark, sf):
    fs, _, test, model = _priority_tree(spark, sf)
    return normalise(ML.permutation_importance(model, test, fs.features, "classification"), ["importancia"], 9)


@query("m4_softmax_boosting", None, note="three-class boosted trees with class weights on the priority features: scored test rows by class")
def m4_softmax_boosting(spark, sf):
    fs, train, test, model = _priority_tree(spark, sf)
    booster = SoftmaxBooster(maxIter=5, maxDepth=3, maxBins=ML.MAX_BINS, weightCol="w_balanced", classes=len(fs.class_labels))
    fitted = booster.fit(PipelineModel(model.stages[:-1]).transform(ML.with_class_weights(train)))
    scored = ML.predict(PipelineModel([*model.stages[:-1], fitted]), test, "classification", fs.class_labels)
    p = F.map_values("probabilidades")
    out = scored.groupBy("label", "prediccion").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(F.get(p, F.lit(k))).alias(f"p{k}") for k in range(len(fs.class_labels))]
    )
    return normalise(out, [f"p{k}" for k in range(len(fs.class_labels))], 4)
