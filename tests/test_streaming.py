"""ST1 / ST2 on real Structured Streaming queries (file source, availableNow)."""

import os

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from panelforge.operators import ml as ML
from panelforge.plans import roles
from panelforge.streaming import captures as ST2
from panelforge.streaming import scoring as ST1


def test_daily_confidence_stream_matches_batch(spark, sf, tmpdir_path):
    cap = roles.capturas(spark, sf)
    src = os.path.join(tmpdir_path, "src")
    cap.write.parquet(src)
    stream = spark.readStream.schema(cap.schema).parquet(src)
    sink, ck = os.path.join(tmpdir_path, "sink"), os.path.join(tmpdir_path, "ck")
    q = ST2.start_daily_confidence(stream, sink, ck, watermark="0 seconds", trigger_once=True)
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    batch = ST2.daily_confidence(cap, watermark=None)
    # append mode emits closed days; the last (open) day waits for the watermark
    assert 0 < got.count() <= batch.count()
    b = {(r.dia, r.tipo_documento): r.n for r in batch.collect()}
    for r in got.collect():
        assert b[(r.dia, r.tipo_documento)] == r.n


def test_daily_days_do_not_depend_on_session_zone(spark, sf):
    cap = roles.capturas(spark, sf)
    utc = {(r.dia, r.tipo_documento, r.n) for r in ST2.daily_confidence(cap, watermark=None).collect()}
    spark.conf.set("spark.sql.session.timeZone", "America/Lima")
    try:
        lima = {(r.dia, r.tipo_documento, r.n) for r in ST2.daily_confidence(cap, watermark=None).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == lima


def test_scoring_stream_splits_accepted_and_rejected(spark, tmpdir_path):
    train = spark.range(200).select((F.col("id") % 10).cast("double").alias("edad"),
                                    F.when(F.col("id") % 2 == 0, "F").otherwise("M").alias("sexo"),
                                    (F.col("id") % 10 > 4).cast("int").alias("label"))
    stages, _ = ML.build_preprocessor(train, ["edad"], ["sexo"])
    model = Pipeline(stages=stages + [DecisionTreeClassifier(labelCol="label")]).fit(train)
    src = os.path.join(tmpdir_path, "req")
    spark.createDataFrame([(1, '{"edad": 7, "sexo": "F"}'), (2, '{"edad": "x"}'), (3, '[{"edad":1,"sexo":"M"},{"sexo":"F"}]')],
                          "request_id int, body string").write.parquet(src)
    stream = spark.readStream.schema("request_id int, body string").parquet(src)
    out, ck = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck")
    q = ST1.start_scoring(stream, model, "classification", ["edad"], ["sexo"], out, ck, class_labels=["normal", "critico"],
                          trigger_once=True)
    q.awaitTermination(120)
    acc = spark.read.parquet(os.path.join(out, "accepted"))
    rej = spark.read.parquet(os.path.join(out, "rejected"))
    assert acc.count() == 2 and rej.count() == 2
    assert {r.prediccion for r in acc.collect()} <= {"normal", "critico"}


def test_resent_requests_are_scored_once(spark, tmpdir_path):
    train = spark.range(40).select((F.col("id") % 10).cast("double").alias("edad"), (F.col("id") % 10 > 4).cast("int").alias("label"))
    stages, _ = ML.build_preprocessor(train, ["edad"], [])
    model = Pipeline(stages=stages + [DecisionTreeClassifier(labelCol="label")]).fit(train)
    src, out, ck = (os.path.join(tmpdir_path, d) for d in ("req", "out", "ck"))

    def send_and_score(*requests):
        schema = "request_id int, body string"
        spark.createDataFrame([(i, f'{{"edad": {x}}}') for i, x in requests], schema).repartition(2).write.mode("append").parquet(src)
        # a new query on the same checkpoint, as after a restart
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        ST1.start_scoring(stream, model, "classification", ["edad"], [], out, ck, ["no", "si"], trigger_once=True,
                          once_within="1 hour").awaitTermination(120)
        return sorted((r.request_id is None, r.request_id) for r in spark.read.parquet(os.path.join(out, "accepted")).collect())

    assert send_and_score((1, 7), (1, 7), (2, 3), (1, 7)) == [(False, 1), (False, 2)]
    assert send_and_score((2, 3), (3, 1), (1, 7), (None, 4), (None, 4)) == [(False, 1), (False, 2), (False, 3), (True, None), (True, None)]
