"""ST2: daily mean OCR confidence and review count per document type.

The same function serves a batch DataFrame and a streaming one; on a stream
the watermark bounds late rows and lets append mode emit each closed day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_confidence(captures: DataFrame, ts: str = "ts", watermark: str | None = "2 days") -> DataFrame:
    """Per calendar day of ``ts`` (wall clock for TIMESTAMP_NTZ input, UTC
    days for TIMESTAMP input) and document type; ``dia`` is that day.

    Watermarks need a TIMESTAMP, so a wall-clock NTZ value is mapped to the
    same wall clock in UTC; windows then align to wall-clock midnights
    whatever the session time zone is.
    """
    tz = captures.sparkSession.conf.get("spark.sql.session.timeZone")
    src = captures.schema[ts].dataType.simpleString()
    event = F.from_utc_timestamp(F.col(ts).cast("timestamp"), tz) if src == "timestamp_ntz" else F.col(ts)
    df = captures.withColumn("_ts", event)
    if watermark:
        df = df.withWatermark("_ts", watermark)
    out = df.groupBy(F.window("_ts", "1 day").alias("window"), "tipo_documento").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("confianza_ocr").alias("confianza_promedio"),
        F.sum("requiere_revision_manual").cast("long").alias("n_revision"),
    )
    return out.withColumn("dia", F.to_date(F.to_utc_timestamp(F.col("window.start"), tz)))


def start_daily_confidence(stream: DataFrame, sink_path: str, checkpoint: str, watermark: str = "2 days", trigger_once: bool = False):
    """Append closed days to a parquet sink; the checkpoint makes it restartable."""
    out = daily_confidence(stream, watermark=watermark).select(
        "dia", F.col("window.start").alias("dia_inicio"), F.col("window.end").alias("dia_fin"), "tipo_documento", "n",
        "confianza_promedio", "n_revision",
    )
    w = out.writeStream.outputMode("append").format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
