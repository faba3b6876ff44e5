"""Scoring a stream of requests.

With a fixed prediction it is stateless, so any trigger and any executor loss gives the same rows. With a registry each batch takes
the newest published model; its version stands in the rows, and a batch that is run again overwrites its own folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import models, scoring


def score_requests(
    requests: DataFrame, predict: Callable[[DataFrame], DataFrame], prob: str, keep: list[str], profile: str = "service"
) -> DataFrame:
    """Validate, map, predict and decide; works on batch and streaming frames alike. Rejected rows are left out."""
    good, _ = scoring.split_valid(scoring.validate(requests, keep=keep))
    return scoring.decide(predict(scoring.request_features(good, keep=keep, profile=profile)), prob)


def rejected_requests(requests: DataFrame, keep: list[str]) -> DataFrame:
    _, bad = scoring.split_valid(scoring.validate(requests, keep=keep))
    return bad


def start_file_sink(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Append a stream to Parquet; the checkpoint folder makes restarts exactly-once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(path)


def start_model_stream(
    stream: DataFrame, registry: str, path: str, checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df, columns: list[str] | None = None, available_now: bool = True,
):
    """Score every batch with the newest model of a registry and write it below ``path`` as ``batch=<id>``.

    ``prepare`` maps raw rows to features; features that the model knows and a row has not are missing values. A model
    is loaded once per version. Rows get the decision columns and ``model_version``; ``columns`` picks among them.
    """
    loaded: dict[int, object] = {}

    def score(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        version = max(models.versions(spark, registry), default=None)
        if version not in loaded:
            loaded.clear()
            version, model = models.load_version(spark, registry, version)
            loaded[version] = model
        model = loaded[version]
        rows = prepare(batch)
        rows = rows.withColumns({f: F.lit(None).cast("double") for f in model.inputs() if f not in rows.columns})
        scored = scoring.decide(model.predict(rows, "_p"), "_p").withColumn("model_version", F.lit(version)).drop("_p")
        scored.select(*(columns or scored.columns)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
