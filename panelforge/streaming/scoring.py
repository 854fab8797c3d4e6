"""ST1: score a stream of JSON requests; rejected items go to a second sink.

Each micro-batch is validated with the batch operators (V1-V6) and scored
with a fitted PipelineModel (M11) inside ``foreachBatch``; both sinks are
idempotent per batch id (overwrite of a batch-id partition), so a retried
batch after an executor loss does not duplicate rows.

A request that is sent again is scored once: the ids seen are kept as keyed
state until they expire (``first_requests``).
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ml as ML
from ..operators import validation as V


ARRIVED = "_arrived"


def first_requests(stream: DataFrame, expiry: str = "1 hour") -> DataFrame:
    """The stream without requests whose ``request_id`` (and ``model``, where
    there is one) came before, in this batch, an earlier one or before a
    restart. Of requests with one id in one batch any one stays.

    Ids are forgotten ``expiry`` after their arrival, which bounds the state
    by the ids of that time. Arrival is the time of the batch, so no request
    is ever late and dropped for it. Requests without an id all stay.
    """
    keys = [c for c in ("request_id", "model") if c in stream.columns]
    named = stream.where(F.col("request_id").isNotNull()).withColumn(ARRIVED, F.current_timestamp())
    first = named.withWatermark(ARRIVED, expiry).dropDuplicatesWithinWatermark(keys).drop(ARRIVED)
    return first.unionByName(stream.where(F.col("request_id").isNull()))


def check_batch(batch: DataFrame, numeric, categorical, registry: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(checked items, requests for models that the registry doesn't know)."""
    unknown = None
    if registry is not None and "model" in batch.columns:
        unknown = V.reject_unknown_model(batch, registry)
        batch = batch.join(registry.select(F.col("name").alias("model")), "model", "left_semi")
    return V.validate_for_model(V.explode_bodies(batch), numeric, categorical), unknown


def score_checked(checked: DataFrame, unknown: DataFrame | None, model: PipelineModel, task: str,
                  class_labels=None) -> tuple[DataFrame, DataFrame]:
    """(scored items, rejected items): 422 for items that fail the checks, 404
    for unknown models, 500 for a class index outside the labels (V7)."""
    rejected = ["request_id", "item_index", "status", "errors"]
    scored = ML.predict(model, checked.where(F.col("status") == 200), task, class_labels)
    bad = checked.where(F.col("status") != 200).select(*rejected)
    keep = ["request_id", "item_index", "prediccion"]
    if task == "classification":
        keep += ["clase_indice", "probabilidades"]
        odd = scored.where(F.col("error_clase").isNotNull())
        bad = bad.unionByName(odd.select("request_id", "item_index", F.lit(500).alias("status"), F.array("error_clase").alias("errors")))
        scored = scored.where(F.col("error_clase").isNull())
    if unknown is not None:
        bad = bad.unionByName(unknown.withColumn("item_index", F.lit(None).cast("int")).select(*rejected))
    return scored.select(*keep), bad


def score_batch(batch: DataFrame, model: PipelineModel, task: str, numeric, categorical, class_labels=None,
                registry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    return score_checked(*check_batch(batch, numeric, categorical, registry), model, task, class_labels)


def start_scoring(stream: DataFrame, model: PipelineModel, task: str, numeric, categorical, out_dir: str, checkpoint: str,
                  class_labels=None, registry: DataFrame | None = None, trigger_once: bool = False,
                  once_within: str | None = None):
    """``once_within``: how long a request's id is remembered (``"1 hour"``), so
    that a resent one is not scored again; None scores every request."""
    if once_within:
        stream = first_requests(stream, once_within)

    def handle(batch: DataFrame, batch_id: int):
        checked, unknown = check_batch(batch, numeric, categorical, registry)
        checked = checked.persist()  # parsed and checked once for both sinks
        try:
            scored, bad = score_checked(checked, unknown, model, task, class_labels)
            scored.write.mode("overwrite").parquet(os.path.join(out_dir, "accepted", f"batch_id={batch_id}"))
            bad.write.mode("overwrite").parquet(os.path.join(out_dir, "rejected", f"batch_id={batch_id}"))
        finally:
            checked.unpersist()

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
