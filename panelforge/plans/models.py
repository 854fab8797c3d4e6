"""The six model specs (M12) and the train / evaluate flows.

A spec names its task, its split kind and how to build its feature set
from the domain tables. The tables can come from the validated CSV loaders
(``sources.files.load_all``) or from the driver-table bindings
(``domain_tables``).
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import metrics as MT
from ..operators import ml as ML
from ..operators import profile as P
from ..operators import splits as H
from ..operators.joins import attach_row
from ..session import cut_lineage
from ..sources import registry as REG
from . import roles


@dataclass(frozen=True)
class ModelSpec:
    name: str
    task: str  # classification | regression
    description: str
    split: str  # stratified | temporal
    build: Callable[[dict], FE.FeatureSet]


# Model names, tasks, descriptions and split kinds of the original registry.
SPECS = {
    s.name: s
    for s in (
        ModelSpec("prioridad_atencion", "classification", "Nivel de prioridad de atencion del paciente (Bajo/Medio/Alto)",
                  "stratified", lambda t: FE.priority_features(t["pacientes"], keys=["paciente_id"])),
        ModelSpec("stock_critico_7d", "classification", "Alerta de stock critico a 7 dias por item de inventario",
                  "temporal", lambda t: FE.stock_features(t["consumo"], t["items"], 7)),
        ModelSpec("stock_critico_14d", "classification", "Alerta de stock critico a 14 dias por item de inventario",
                  "temporal", lambda t: FE.stock_features(t["consumo"], t["items"], 14)),
        ModelSpec("demanda_consumo", "regression", "Consumo diario esperado por item (serie con lags de 1/7/14 dias)",
                  "temporal", lambda t: FE.demand_features(t["consumo"], t["items"])),
        ModelSpec("duracion_estadia", "regression", "Dias de hospedaje estimados del paciente al momento del ingreso",
                  "stratified", lambda t: FE.stay_features(t["pacientes"], keys=["paciente_id"])),
        ModelSpec("proyeccion_donaciones", "regression", "Valor mensual proyectado de donaciones (S/) por categoria",
                  "temporal", lambda t: FE.donation_features(t["donaciones"])),
    )
}


def domain_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "pacientes": roles.pacientes(spark, sf_dir),
        "consumo": roles.consumo(spark, sf_dir),
        "items": roles.catalogue(spark, sf_dir),
        "donaciones": roles.donaciones(spark, sf_dir),
        "capturas_ia": roles.capturas(spark, sf_dir),
    }


def spec(name: str) -> ModelSpec:
    """Unknown names raise with the known list."""
    if name not in SPECS:
        raise KeyError(f"unknown model {name!r}; available: {list(SPECS)}")
    return SPECS[name]


def split_feature_set(s: ModelSpec, fs: FE.FeatureSet) -> tuple[DataFrame, DataFrame]:
    """H1 / H2 / H3 by the spec's split kind; random splits hash the row id
    (the full feature row where a set has none)."""
    keys = fs.keys or [*fs.features, "label"]
    if s.split == "temporal":
        parts = H.temporal_split(fs.df, fs.date).drop("cutoff")
    elif s.task == "classification":
        parts = H.stratified_split(fs.df, "label", keys)
    else:
        parts = H.hash_split(fs.df, keys)
    train = parts.where(F.col("split") == "train").drop("split")
    test = parts.where(F.col("split") == "test").drop("split")
    return train, test


def train_one(spark: SparkSession, tables: dict, name: str, tuning: bool = False, n_iter: int = 15,
              model_dir: str | None = None) -> tuple[dict, DataFrame]:
    """M8 + M9 (+ S14): returns the registry entry and the comparison table."""
    s = spec(name)
    # the feature table feeds the split, every fit and the vocabulary: write
    # it once to the shared checkpoint folder (also keeps the split's plan small)
    fs = s.build(tables)
    fs = FE.assert_not_empty(replace(fs, df=cut_lineage(fs.df)), name)
    train, test = split_feature_set(s, fs)
    train, test = cut_lineage(train), cut_lineage(test)
    counts = {"train": train.count(), "test": test.count()}
    if not counts["train"] or not counts["test"]:
        raise ValueError(f"{name}: the split left an empty side")
    time_folds = H.expanding_folds(train, fs.date, 3) if (s.split == "temporal" and tuning) else None
    if s.split != "temporal" and tuning:
        train = H.hash_folds(train, fs.keys or [*fs.features, "label"])
    best, ranked = ML.select_model(fs, train, test, s.task, tuning=tuning, n_iter=n_iter, time_folds=time_folds)
    if model_dir:
        ML.save_model(best.model, os.path.join(model_dir, name))
    vocab = {}
    if fs.categorical:
        for r in P.vocabulary_arrays(train, fs.categorical).collect():
            vocab[r["variable"]] = list(r["values"])
    entry = ML.registry_entry(name, s.task, s.description, s.split, best, ranked, fs, vocab, counts["train"], counts["test"])
    return entry, ML.comparison_frame(spark, ranked)


def train(spark: SparkSession, tables: dict, names: list[str] | None = None, tuning: bool = False, n_iter: int = 15,
          registry_path: str | None = None, model_dir: str | None = None) -> DataFrame:
    """Train the named models (all by default) and upsert them into the registry."""
    names = names or list(SPECS)
    wanted = [spec(n).name for n in names]  # a wrong name fails before any fit
    new = REG.entries_frame(spark, [train_one(spark, tables, n, tuning, n_iter, model_dir)[0] for n in wanted])
    return REG.commit_entries(new, registry_path) if registry_path else new


def evaluate(spark: SparkSession, tables: dict, name: str, model_dir: str) -> dict[str, DataFrame]:
    """Rebuild the same split, load the winner, and produce the reports."""
    s = spec(name)
    fs = s.build(tables)
    fs = replace(fs, df=cut_lineage(fs.df))
    _, test = split_feature_set(s, fs)
    model = ML.load_model(os.path.join(model_dir, name))
    scored = ML.predict(model, test, s.task, fs.class_labels)
    out = {
        "importance": ML.feature_importance(spark, model),
        "permutation": ML.permutation_importance(model, test, fs.features, s.task),
    }
    if s.task == "classification":
        pairs = scored.select(F.col("label").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"))
        out["metrics"] = MT.classification_metrics(pairs)
        names = fs.class_labels or ["0", "1"]
        named = lambda c: F.element_at(F.array(*[F.lit(n) for n in names]), F.col(c) + 1).alias(c)
        labelled = pairs.select(named("y_true"), named("y_pred"))
        out["report"] = MT.class_report(labelled)
        out["confusion"] = MT.confusion_matrix(labelled, names)
    else:
        pairs = scored.select(F.col("label").alias("y_true"), F.col("prediction").alias("y_pred"))
        out["metrics"] = MT.regression_metrics(pairs)
        out["points"] = pairs
        out["range"] = P.prediction_range(pairs)
    out["n_test"] = scored.agg(F.count(F.lit(1)).alias("n_test"))
    return out


def evaluate_all(spark: SparkSession, tables: dict, registry: DataFrame, model_dir: str,
                 names: list[str] | None = None) -> tuple[DataFrame, dict[str, dict[str, DataFrame]]]:
    """A28 over all models of the registry (or the named ones): (summary, reports).

    The summary has a row per model: its name, task, algorithm, test rows and
    metrics; a metric of the other task is NULL. A name that the registry
    doesn't have is an error before anything is evaluated."""
    known = {r["name"]: r for r in registry.select("name", "task", "selected_algorithm").collect()}
    names = list(known) if names is None else names
    if wrong := [n for n in names if n not in known]:
        raise KeyError(f"not in the registry: {wrong}; available: {sorted(known)}")
    if not names:
        raise ValueError("no model to evaluate")
    reports = {n: evaluate(spark, tables, n, model_dir) for n in names}
    rows = [
        attach_row(
            reports[n]["metrics"].select(
                F.lit(n).alias("modelo"), F.lit(known[n]["task"]).alias("tarea"),
                F.lit(known[n]["selected_algorithm"]).alias("algoritmo"), "*",
            ),
            reports[n]["n_test"],
        )
        for n in names
    ]
    summary = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    first = ["modelo", "tarea", "algoritmo", "n_test"]
    return summary.select(*first, *[c for c in summary.columns if c not in first]), reports
