"""Incremental ingestion (S8, streaming form): only new input files are processed.

The reference skips inputs whose output already exists. Here a file-source Structured Streaming query with
``trigger(availableNow=True)`` processes every file not yet recorded in its checkpoint, then stops; rerunning it
later picks up only files that arrived since. The caller names the checkpoint folder, which must be the same in every run and on
shared storage, so a later or restarted job resumes where the last one stopped. Each micro-batch goes through the same
waterfall and replaces the folder ``batch_id=<n>``: a batch that is replayed after a failure overwrites what it had written.
Gzip files are not splittable, so a batch of few files is dealt to several tasks a core before its documents are filtered.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsift.operators import waterfall as WF
from textsift.sources.readers import DOCUMENT_SCHEMA, spread_files


def read_documents_stream(spark: SparkSession, path: str, glob: str = "*.jsonl.gz",
                          max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(DOCUMENT_SCHEMA).option("pathGlobFilter", glob)
         .option("recursiveFileLookup", "true").option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def incremental_filter(spark: SparkSession, input_path: str, output_path: str, *, checkpoint: str,
                       params: WF.FilterParams = WF.FilterParams(), glob: str = "*.jsonl.gz"):
    """Run the waterfall over files not processed before; returns the finished ``StreamingQuery``.

    Input records carry ``metadata.language``/``metadata.language_score`` from the language step.
    """
    src = read_documents_stream(spark, input_path, glob)
    flat = src.select("id", "text", F.col("metadata.url").alias("url"), F.col("metadata.date").alias("date"),
                      F.col("metadata.language").alias("language"),
                      F.col("metadata.language_score").alias("language_score"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        folder = posixpath.join(output_path, "labelled", f"batch_id={batch_id}")
        labelled = WF.label(spread_files(batch), params)
        labelled.write.mode("overwrite").partitionBy("filter_step").parquet(folder)

    q = (flat.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
