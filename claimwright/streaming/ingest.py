"""Incremental file ingest: new files become micro-batches, bad lines a table of their own."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import columns as fx
from ..sources.files import NA_TOKENS


def stream_files(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "csv", files_per_batch: int | None = None, **options
) -> DataFrame:
    """An unbounded DataFrame over a folder; each file is read exactly once per checkpoint.

    Text that does not fit the schema stops the stream, unless ``mode`` says otherwise.
    """
    reader = spark.readStream.schema(schema).format(fmt).options(**({"mode": "FAILFAST"} if fmt not in ("parquet", "text") else {}) | options)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def run_batches(stream: DataFrame, checkpoint: str, body: Callable[[DataFrame, int], None]) -> None:
    """``body`` for every micro-batch of what is new, then stop.

    A batch that was interrupted comes again under its number, so ``body`` writes to places named
    by the number and overwrites them.
    """
    stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def parse_lines(lines: DataFrame, schema: T.StructType, sep: str = ",", na_values: Sequence[str] = NA_TOKENS, column: str = "value") -> DataFrame:
    """One row per delimited line: its typed fields, and ``line`` and ``error`` where it is bad.

    A line is bad if it has too few or too many fields or one that does not parse as its type.
    Missing-value texts are null.
    """
    texts = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(len(schema.fields))] + [T.StructField("ragged", T.StringType())])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "ragged"}
    fields_of = F.from_csv(fx.quoted(column), texts.simpleString()[7:-1].replace(":", " "), options)
    # as rows of a generator the fields are parsed once, also below a filter on what is made of them
    parsed = lines.select(fx.quoted(column).alias("line"), F.explode(F.array(fields_of)).alias("f"))
    fields, wrong = {}, []
    for i, f in enumerate(schema.fields):
        text = F.col(f"f.f{i}")
        text = F.when(~text.isin(list(na_values)), text)
        fields[f.name] = text.try_cast(f.dataType)
        wrong.append(F.when(text.isNotNull() & fields[f.name].isNull(), F.lit(f.name)))
    named = F.array_compact(F.array(*wrong))
    error = F.when(F.col("f.ragged").isNotNull(), F.lit("wrong number of fields")).when(F.size(named) > 0, F.concat(F.lit("bad value: "), F.array_join(named, ", ")))
    typed = parsed.withColumns({"error": error, "line": F.when(error.isNotNull(), F.col("line"))})
    return typed.select(*[fields[f.name].alias(f.name) for f in schema.fields], "line", "error")


def scan_partitions(
    spark: SparkSession,
    folder: str,
    output: str,
    checkpoint: str,
    schema: T.StructType,
    fmt: str = "csv",
    files_per_batch: int | None = None,
    rejected: str | None = None,
    sep: str = ",",
    na_values: Sequence[str] = NA_TOKENS,
    **options,
) -> None:
    """Write everything new in ``folder`` to a Parquet folder, one ``batch=n`` below it per micro-batch, then stop.

    Running it again with the same checkpoint picks up only files that arrived since, and a batch
    that is repeated after a failure replaces its own files. Delimited text has a header line in
    every file; its bad lines go with their error to ``rejected``, and stop the stream if there is
    no such place.
    """
    if fmt != "csv":
        run_batches(stream_files(spark, folder, schema, fmt, files_per_batch, **options), checkpoint, lambda batch, n: batch.write.mode("overwrite").parquet(f"{output}/batch={n}"))
        return
    header = sep.join(f.name for f in schema.fields)

    def write(batch: DataFrame, n: int) -> None:
        rows = parse_lines(batch.where((F.col("value") != header) & (F.col("value") != "")), schema, sep, na_values)
        good, bad = rows.where("error IS NULL").drop("line", "error"), rows.where("error IS NOT NULL").select("line", "error")
        if rejected is None:
            first = bad.first()
            if first:
                raise ValueError(f"{first['error']}: {first['line']}")
        else:
            bad.write.mode("overwrite").parquet(f"{rejected}/batch={n}")
        good.write.mode("overwrite").parquet(f"{output}/batch={n}")

    run_batches(stream_files(spark, folder, T.StructType([T.StructField("value", T.StringType())]), "text", files_per_batch), checkpoint, write)
