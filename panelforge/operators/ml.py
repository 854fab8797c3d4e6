"""Model pipeline on Spark ML.

* M1 preprocessing: exact-median imputation, fitted with the pipeline, so
  inside each fold (distributed quantiles, one value per column reaches the
  driver) + StringIndexer(keep) + OneHotEncoder
  (dropLast drops the unknown slot, so unseen categories encode as zeros and
  every known value keeps its slot) + VectorAssembler.
* M2-M4 candidates: decision tree, random forest, boosted trees (several
  classes: the softmax booster of ``operators.boosting``, GBT is binary only).
* M5 class weights ('balanced', positive class) as weight columns.
* M6 random search: a seeded draw of parameter maps, all scored in one
  ``CrossValidator(foldCol=...)`` with macro F1 or MAE; time folds use their
  own loop.
* M8 model selection on the cross-validation score (untuned: on the test
  side); M9 registry entry;
  M11 scoring with label and probability map.
"""

from __future__ import annotations

import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator as _Evaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import strip_encoder_prefix
from ..session import cut_lineage
from .boosting import SoftmaxBooster
from .features import FeatureSet
from .joins import attach_row
from .metrics import classification_metrics, regression_metrics
from .quantiles import quantiles_columns
from .validation import class_from_index

SEED = 42
MAX_DEPTH = 30  # Spark's limit; stands for "unlimited"


# M1 ------------------------------------------------------------------------
def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Exact (interpolated) medians; one number per column comes back."""
    if not cols:
        return {}
    rows = quantiles_columns(df, cols, [0.5]).collect()
    return {r["variable"]: r["value"] for r in rows}


class MedianImputer(Estimator):
    """Adds ``<column>__imp`` with NULLs replaced by the exact median of the
    rows it is fitted on, so a pipeline inside a cross-validation never sees
    the medians of its validation rows. A column that is all NULL there gets 0."""

    def __init__(self, cols: list[str]):
        super().__init__()
        self.cols = cols

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        med = exact_medians(dataset, self.cols)
        fills = [f"COALESCE(CAST(`{c}` AS DOUBLE), {float(med[c] or 0.0)!r}) AS `{c}__imp`" for c in self.cols]
        return SQLTransformer(statement=", ".join(["SELECT *", *fills]) + " FROM __THIS__")


def build_preprocessor(train: DataFrame, numeric: list[str], categorical: list[str]) -> tuple[list, list[str]]:
    """Stages and the kept numeric columns (all-NULL numeric columns dropped)."""
    counts = train.agg(*[F.count(c).alias(c) for c in numeric]).first() if numeric else {}
    kept = [c for c in numeric if counts[c] > 0]
    stages = [MedianImputer(kept)]
    idx_cols = [f"{c}__idx" for c in categorical]
    oh_cols = [f"{c}__oh" for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=idx_cols, handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=idx_cols, outputCols=oh_cols, dropLast=True))
    stages.append(VectorAssembler(inputCols=[f"{c}__imp" for c in kept] + oh_cols, outputCol="features", handleInvalid="keep"))
    return stages, kept


# M5 ------------------------------------------------------------------------
WEIGHTS = ("w_one", "w_balanced", "w_positive")


def with_class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Weight columns by class: 1, n / (k * n_class) ('balanced'), and the
    boosted trees' n_negative / n_positive for class 1 of two (else 1).

    The class table has a row for each class of a fitted label (broadcast)."""
    n, c = F.col("_n"), F.col("_nc")
    counts = df.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_nc"))
    total = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    positive = F.when((F.col("_k") == 2) & (F.col("_class") == 1), (n - c) / c).otherwise(F.lit(1.0))
    w = attach_row(counts, total).select(
        "_class", F.lit(1.0).alias("w_one"), (n / (F.col("_k") * c)).alias("w_balanced"), positive.alias("w_positive")
    )
    return df.join(F.broadcast(w), df[label].eqNullSafe(w["_class"])).drop("_class")


# M2-M4 ---------------------------------------------------------------------
# ---------------------------------------------------------------------------
# What the search draws from, by algorithm.
# ---------------------------------------------------------------------------
MAX_BINS = 64
LEAF_ROWS_TREE = range(1, 40)
LEAF_ROWS = range(1, 10)
TREE_DEPTHS = {"classification": [4, 6, 8, 12, 16, 24, MAX_DEPTH], "regression": [4, 6, 8, 12, 16, MAX_DEPTH]}
FOREST_TREES = [200, 300, 500]
FOREST_DEPTHS = [MAX_DEPTH, 12, 18, 26]
FOREST_FEATURES = {"classification": ["sqrt", "0.5"], "regression": ["sqrt", "0.5", "all"]}
BOOST_ROUNDS = [200, 400, 600]
BOOST_DEPTHS = range(3, 10)
BOOST_STEP = (0.03, 0.2)
BOOST_SAMPLE = (0.7, 1.0)
BOOST_COLUMNS = (0.7, 1.0)
BOOST_CHILD_WEIGHT = range(1, 10)
# Untuned trees and forests grow as deep as Spark allows. A caller can set others here.
UNTUNED: dict[str, dict] = {"decision_tree": {"maxDepth": MAX_DEPTH}, "random_forest": {"maxDepth": MAX_DEPTH}, "boosted": {}}
# ---------------------------------------------------------------------------

_LEARNERS = {
    "decision_tree": {"classification": DecisionTreeClassifier, "regression": DecisionTreeRegressor},
    "random_forest": {"classification": RandomForestClassifier, "regression": RandomForestRegressor},
    "boosted": {"classification": GBTClassifier, "regression": GBTRegressor},
}


@dataclass(frozen=True)
class Candidate:
    """An algorithm for a task: estimator, what an untuned fit sets, and what
    a search draws (a sequence: one of it; a pair of floats: uniform)."""

    name: str
    estimator: object
    untuned: dict
    space: dict

    def param_map(self, values: dict, task: str) -> dict:
        """``values`` as Spark params; the weight column follows 'balanced'
        (boosted trees of two classes weigh the positive one)."""
        values = dict(values)
        balanced = values.pop("balanced", False)
        out = {self.estimator.getParam(k): v for k, v in values.items()}
        if task == "classification":
            two = self.name == "boosted" and not isinstance(self.estimator, SoftmaxBooster)
            out[self.estimator.getParam("weightCol")] = "w_positive" if two else "w_balanced" if balanced else "w_one"
        return out


def candidates(task: str, n_classes: int | None = None) -> list[Candidate]:
    if task not in TREE_DEPTHS:
        raise ValueError(f"no candidates for task {task!r}")
    spaces = {
        "decision_tree": {"maxDepth": TREE_DEPTHS[task], "minInstancesPerNode": LEAF_ROWS_TREE},
        "random_forest": {"numTrees": FOREST_TREES, "maxDepth": FOREST_DEPTHS, "minInstancesPerNode": LEAF_ROWS,
                          "featureSubsetStrategy": FOREST_FEATURES[task]},
        "boosted": {"maxIter": BOOST_ROUNDS, "maxDepth": BOOST_DEPTHS, "stepSize": BOOST_STEP,
                    "subsamplingRate": BOOST_SAMPLE, "minInstancesPerNode": LEAF_ROWS},
    }
    out = []
    for name, space in spaces.items():
        est = _LEARNERS[name][task](seed=SEED, featuresCol="features", labelCol="label", maxBins=MAX_BINS)
        if name == "boosted" and task == "classification" and (n_classes or 2) > 2:
            est = SoftmaxBooster(seed=SEED, maxBins=MAX_BINS, classes=n_classes)
            space = {k: v for k, v in space.items() if k != "minInstancesPerNode"}
            space |= {"columnRate": BOOST_COLUMNS, "minChildWeight": BOOST_CHILD_WEIGHT, "balanced": [False, True]}
        elif task == "classification" and name != "boosted":
            space = {**space, "balanced": [False, True]}
        out.append(Candidate(name, est, UNTUNED[name], space))
    return out


def draw_params(space: dict, n_iter: int, seed: int = SEED) -> list[dict]:
    """M6: seeded random draws from the search space (driver-side, tiny)."""
    rng = random.Random(seed)
    uniform = lambda v: isinstance(v, tuple) and len(v) == 2
    return [{k: rng.uniform(*v) if uniform(v) else rng.choice(v) for k, v in space.items()} for _ in range(n_iter)]


class MacroF1Evaluator(_Evaluator):
    """Spark's multiclass 'f1' is weighted; selection uses macro F1."""

    def _evaluate(self, dataset):
        m = classification_metrics(dataset.select(F.col("label").cast("int").alias("y_true"),
                                                  F.col("prediction").cast("int").alias("y_pred")))
        return float(m.first()["f1_macro"])

    def isLargerBetter(self):
        return True


class NegMAEEvaluator(_Evaluator):
    def _evaluate(self, dataset):
        return -float(dataset.agg(F.avg(F.abs(F.col("prediction") - F.col("label")))).first()[0])

    def isLargerBetter(self):
        return True


@dataclass
class Fitted:
    algorithm: str
    model: PipelineModel
    params: dict
    cv_score: float | None
    metrics: dict


def _evaluate(model: PipelineModel, test: DataFrame, task: str) -> dict:
    pred = model.transform(test)
    if task == "classification":
        m = classification_metrics(pred.select(F.col("label").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred")))
    else:
        m = regression_metrics(pred.select(F.col("label").alias("y_true"), F.col("prediction").alias("y_pred")))
    return {k: float(v) if v is not None else None for k, v in m.first().asDict().items()}


def time_fold_bounds(folds: DataFrame) -> list[tuple]:
    """(lo, hi) of each expanding fold: a few dates."""
    return [(f["lo"], f["hi"]) for f in folds.orderBy("fold").collect()]


def _time_fold_scores(pipe: Pipeline, maps: list[dict], data: DataFrame, bounds: list[tuple], date: str, evaluator,
                      parallelism: int = 4) -> list[float]:
    """H6 + M6: mean score of each param map over expanding time folds (train
    before ``lo``, test in [lo, hi)); the maps of a fold are fitted side by side."""
    totals = [0.0] * len(maps)
    for lo, hi in bounds:
        train = data.where(F.col(date) < F.lit(lo))
        test = data.where(F.col(date) >= F.lit(lo))
        if hi is not None:
            test = test.where(F.col(date) < F.lit(hi))
        with ThreadPoolExecutor(parallelism) as pool:
            scores = list(pool.map(lambda m: evaluator.evaluate(pipe.fit(train, m).transform(test)), maps))
        totals = [t + x for t, x in zip(totals, scores, strict=True)]
    return [t / len(bounds) for t in totals]


def fit_candidate(cand: Candidate, fs: FeatureSet, train: DataFrame, test: DataFrame, task: str, tuning: bool,
                  n_iter: int, folds: int = 3, time_bounds: list[tuple] | None = None,
                  prepared: PipelineModel | None = None) -> Fitted:
    """One candidate, tuned by a random search or with its untuned settings.

    ``prepared``: a preprocessor fitted on all of ``train``, for the final fit
    (the search refits it on each fold's training rows)."""
    data = with_class_weights(train) if task == "classification" else train
    stages, _ = build_preprocessor(train, fs.numeric, fs.categorical)
    values, score = cand.untuned, None
    if tuning:
        draws = draw_params(cand.space, n_iter)
        maps = [cand.param_map(d, task) for d in draws]
        pipe = Pipeline(stages=[*stages, cand.estimator])
        evaluator = MacroF1Evaluator() if task == "classification" else NegMAEEvaluator()
        if time_bounds and fs.date:
            scores = _time_fold_scores(pipe, maps, data, time_bounds, fs.date, evaluator)
        else:
            by = {"foldCol": "fold"} if "fold" in data.columns else {}
            cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds,
                                parallelism=4, seed=SEED, **by)
            scores = [float(x) for x in cv.fit(data).avgMetrics]
        best = max(range(len(draws)), key=lambda i: scores[i])
        values, score = draws[best], scores[best]
    prepared = prepared or Pipeline(stages=stages).fit(train)
    fitted = cand.estimator.copy(cand.param_map(values, task)).fit(prepared.transform(data))
    model = PipelineModel(stages=[*prepared.stages, fitted])
    return Fitted(cand.name, model, values if tuning else {}, score, _evaluate(model, test, task))


def select_model(fs: FeatureSet, train: DataFrame, test: DataFrame, task: str, tuning: bool = False, n_iter: int = 15,
                 select_on: str = "cv", time_folds: DataFrame | None = None) -> tuple[Fitted, list[Fitted]]:
    """M8: fit the three candidates, rank by macro F1 (desc) or MAE (asc): of
    the cross-validation if there was one (``select_on="test"``: of the test
    side, as for untuned fits)."""
    n_classes = len(fs.class_labels) if fs.class_labels else None
    bounds = time_fold_bounds(time_folds) if time_folds is not None else None
    stages, _ = build_preprocessor(train, fs.numeric, fs.categorical)
    prepared = Pipeline(stages=stages).fit(train)  # medians and vocabularies once for all candidates
    fitted = [
        fit_candidate(c, fs, train, test, task, tuning, n_iter, time_bounds=bounds, prepared=prepared)
        for c in candidates(task, n_classes)
    ]

    def loss(f: Fitted) -> float:
        if select_on == "cv" and f.cv_score is not None:
            return -f.cv_score
        value = f.metrics.get("f1_macro" if task == "classification" else "mae")
        if value is None:
            return math.inf
        return -value if task == "classification" else value

    ranked = sorted(fitted, key=lambda f: (loss(f), f.algorithm))
    return ranked[0], ranked


def comparison_frame(spark, ranked: list[Fitted]) -> DataFrame:
    """One row per algorithm, ``rank`` 1 the selected one."""
    keys = sorted({k for f in ranked for k in f.metrics})
    schema = "rank int, algoritmo string, cv_score double, mejores_hiperparametros string, " + ", ".join(f"{k} double" for k in keys)
    rows = [(i, f.algorithm, f.cv_score, json.dumps(f.params, default=str), *[f.metrics.get(k) for k in keys])
            for i, f in enumerate(ranked, 1)]
    return spark.createDataFrame(rows, schema)


def registry_entry(name: str, task: str, description: str, split: str, best: Fitted, ranked: list[Fitted],
                   fs: FeatureSet, categorical_values: dict, n_train: int, n_test: int) -> dict:
    """M9: the registry row, with the metrics of all algorithms tried."""
    return {
        "name": name,
        "task": task,
        "description": description,
        "split": split,
        "selection_metric": "f1_macro" if task == "classification" else "mae",
        "selected_algorithm": best.algorithm,
        "best_hyperparameters": json.dumps(best.params, default=str),
        "all_algorithms": {f.algorithm: {k: v for k, v in f.metrics.items() if v is not None} for f in ranked},
        "metrics": best.metrics,
        "numeric_features": fs.numeric,
        "categorical_features": fs.categorical,
        "categorical_values": categorical_values,
        "class_labels": fs.class_labels,
        "n_train": n_train,
        "n_test": n_test,
        "trained_at": datetime.now(timezone.utc).isoformat(),
    }


# A27 -----------------------------------------------------------------------
def slot_importances(last) -> list[float]:
    """Importance of each assembled slot: the model's own, or of a
    one-vs-rest model the mean over its classes."""
    if isinstance(last, OneVsRestModel):
        each = [m.featureImportances.toArray() for m in last.models]
        return (sum(each) / len(each)).tolist()
    own = getattr(last, "featureImportances", None)
    if own is None:
        raise ValueError(f"{type(last).__name__} has no importances; use permutation_importance")
    return own.toArray().tolist()


def feature_importance(spark, model: PipelineModel, top_n: int | None = None) -> DataFrame:
    """Importances per assembled slot with the encoder's slot names (T3: the
    ``top_n`` largest when given)."""
    rows = [(n, float(v)) for n, v in zip(slot_names(model), slot_importances(model.stages[-1]), strict=True)]
    named = spark.createDataFrame(rows, "variable string, importancia double")
    out = named.withColumn("variable", strip_encoder_prefix("variable")).orderBy(F.col("importancia").desc(), "variable")
    return out.limit(top_n) if top_n else out


#: Rows within which a column's values are permuted.
PERMUTED_ROWS = 10_000


def permutation_importance(model: PipelineModel, rows: DataFrame, columns: list[str], task: str, seed: int = SEED) -> DataFrame:
    """(variable, importancia): what a column's permutation costs in macro F1
    or adds to the MAE, for any model.

    Rows are put in the order of a seeded hash inside blocks of about
    ``PERMUTED_ROWS``; each takes the next one's value. All columns are
    scored in one pass: a row goes in once as it is and once for each column.
    """
    rows = cut_lineage(rows.select("label", *columns).withColumn("_row", F.monotonically_increasing_id()))
    blocks = max(1, math.ceil(rows.count() / PERMUTED_ROWS))
    block = F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(blocks))
    # a row's place is another hash than its block, or the order would be the same in all runs
    placed = rows.withColumn("_block", block).withColumn("_at", F.xxhash64(F.lit(seed), "_row"))
    by = Window.partitionBy("_block").orderBy("_at", "_row")
    own = F.struct(*columns)
    first = F.first(own).over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    moved = placed.withColumn("_next", F.coalesce(F.lead(own).over(by), first))
    variant = lambda c: F.struct(F.lit(c).alias("_variant"), *[F.col(f"_next.{x}" if x == c else x).alias(x) for x in columns])
    each = moved.select("label", F.explode(F.array(*[variant(c) for c in [None, *columns]])).alias("_v")).select("label", "_v.*")
    scored = model.transform(each).select("_variant", F.col("label").cast("double").alias("y"), F.col("prediction").alias("p"))
    if task != "classification":
        scores = scored.groupBy("_variant").agg((-F.avg(F.abs(F.col("p") - F.col("y")))).alias("score"))
    else:
        scores = macro_f1_by(scored, "_variant")
    base = scores.filter("_variant IS NULL").select(F.col("score").alias("_base"))
    out = attach_row(scores.filter("_variant IS NOT NULL"), base)
    return out.select(F.col("_variant").alias("variable"), (F.col("_base") - F.col("score")).alias("importancia"))


def macro_f1_by(pairs: DataFrame, by: str) -> DataFrame:
    """(by, score): macro F1 of (y, p) over the classes that occur in either."""
    cells = pairs.groupBy(by, "y", "p").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    as_true = cells.select(by, F.col("y").alias("c"), F.col("n").alias("t"), F.lit(0).alias("q"), hit.alias("h"))
    as_said = cells.select(by, F.col("p").alias("c"), F.lit(0).alias("t"), F.col("n").alias("q"), F.lit(0).alias("h"))
    classes = as_true.unionByName(as_said).groupBy(by, "c").agg(F.sum("t").alias("t"), F.sum("q").alias("q"), F.sum("h").alias("h"))
    return classes.groupBy(by).agg(F.avg(F.lit(2.0) * F.col("h") / (F.col("t") + F.col("q"))).alias("score"))


def slot_names(model: PipelineModel) -> list[str]:
    """Names of the assembled slots as the encoder gives them: ``num__x``, and
    ``cat__x_value`` for each known value (the unknown one has no slot)."""
    values = {c: v for st in model.stages if hasattr(st, "labelsArray") for c, v in zip(st.getInputCols(), st.labelsArray, strict=True)}
    inputs = next((st.getInputCols() for st in model.stages if isinstance(st, VectorAssembler)), [])
    out = []
    for name in inputs:
        base = name.removesuffix("__imp").removesuffix("__oh")
        out += [f"cat__{base}_{v}" for v in values[base]] if base in values else [f"num__{base}"]
    return out


# M11 -----------------------------------------------------------------------
def predict(model: PipelineModel, rows: DataFrame, task: str, class_labels: list[str] | None = None) -> DataFrame:
    """Scored rows: ``prediccion`` (label or value), ``clase_indice``,
    ``probabilidades`` map label -> probability, ``error_clase`` (a class index
    outside the labels, V7). Numbers pass through FLOAT, as the scoring tensors did."""
    numbers = [c.removesuffix("__imp") for st in model.stages if isinstance(st, VectorAssembler) for c in st.getInputCols() if c.endswith("__imp")]
    out = model.transform(rows.withColumns({c: F.col(c).cast("float").cast("double") for c in numbers}))
    if task != "classification":
        return out.withColumn("prediccion", F.col("prediction"))
    labels = F.array(*[F.lit(x) for x in (class_labels or [])])
    idx = F.col("prediction").cast("int")
    label, error = class_from_index(idx, class_labels or [])
    if "probability" in out.columns:
        probs = vector_to_array(F.col("probability"))
    else:
        # OneVsRest over GBT: per-class margins -> logistic, then normalised
        margins = vector_to_array(F.col("rawPrediction"))
        p = F.transform(margins, lambda m: F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * m)))
        probs = F.transform(p, lambda x: x / F.aggregate(p, F.lit(0.0), lambda a, b: a + b))
    return out.withColumns({
        "clase_indice": idx,
        "prediccion": label,
        "error_clase": error,
        "probabilidades": F.map_from_arrays(labels, probs),
    })


def save_model(model: PipelineModel, path: str) -> None:
    """Spark ML persistence (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    spark = SparkSession.active()
    there = spark._jvm.org.apache.hadoop.fs.Path(path, "metadata")
    if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        raise FileNotFoundError(f"no trained model at {path}; train it first")
    return PipelineModel.load(path)
