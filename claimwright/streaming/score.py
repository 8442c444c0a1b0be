"""Scoring request records as they arrive, by the model in production. Stateless, so no watermark is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import columns as fx
from ..operators.registry import ModelRegistry
from ..operators.scoring import REQUEST_DEFAULTS, score_batch
from .ingest import run_batches, stream_files

TEXT_FIELDS = ["request_id", *REQUEST_DEFAULTS]
RECORD = "array<struct<" + ",".join(f"{f}:string" for f in TEXT_FIELDS) + ">>"


def parse_requests(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per record of each JSON line (one object or a list of them), with an ``error`` text.

    Fields are read as text and cast one by one, so that a bad value marks its own record only.
    """
    parsed = lines.select(fx.quoted(column).alias("body"), F.from_json(fx.quoted(column), RECORD).alias("records"))
    usable = F.col("records").isNotNull() & (F.size("records") > 0)
    padded = F.when(usable, F.col("records")).otherwise(F.array(F.lit(None).cast(RECORD[6:-1])))
    rows = parsed.select("body", F.explode(padded).alias("r"))
    typed, bad = {"request_id": F.col("r.request_id")}, []
    for name, default in REQUEST_DEFAULTS.items():
        raw = F.col(f"r.{name}")
        if isinstance(default, str):
            typed[name] = raw
            continue
        typed[name] = raw.try_cast("double" if isinstance(default, float) else "int")
        bad.append(F.when(raw.isNotNull() & typed[name].isNull(), F.lit(name)))
    wrong = F.array_compact(F.array(*bad))
    error = F.when(F.col("r").isNull(), F.lit("not a JSON record")).when(
        F.size(wrong) > 0, F.concat(F.lit("bad value: "), F.array_join(wrong, ", "))
    )
    return rows.select("body", *[v.alias(k) for k, v in typed.items()], error.alias("error"))


def score_requests(lines: DataFrame, model, model_version: str = "unknown", column: str = "value") -> DataFrame:
    """Scored records; a bad one carries its error and no prediction. Batch or streaming input."""
    requests = parse_requests(lines, column)
    scored = score_batch(model, requests, ["request_id", "error"], model_version)
    good = F.col("error").isNull()
    return scored.select(
        "request_id",
        good.alias("success"),
        F.when(good, F.col("predicted_amount")).alias("predicted_amount"),
        F.when(good, F.col("confidence_interval")).alias("confidence_interval"),
        "model_version",
        "error",
    )


def stream_score(spark: SparkSession, folder: str, output: str, checkpoint: str, registry: ModelRegistry) -> None:
    """Score every new file of JSON lines in ``folder`` into a Parquet folder, then stop.

    Each micro-batch asks the registry for the model in production, so a promotion takes effect with
    the next batch. A batch that is repeated replaces its own files.
    """

    def score(batch: DataFrame, n: int) -> None:
        found = registry.production()
        if found is None:
            raise RuntimeError("no model is in production")
        score_requests(batch, *found).write.mode("overwrite").parquet(f"{output}/batch={n}")

    run_batches(stream_files(spark, folder, T.StructType([T.StructField("value", T.StringType())]), "text"), checkpoint, score)
