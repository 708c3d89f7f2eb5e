"""Landed documents as a stream (S8, S10, K1, K12), with a run-log row per micro-batch.

Files of JSON Lines land in a folder; each micro-batch parses the lines of the new files
once and writes good and rejected documents, with the file each came from, to a folder of its own
(``batch=<n>/rejected=<b>``).  A micro-batch that is run again after a failure overwrites just that
folder, so every document counts exactly once however often a batch is tried.  What
became of each try is stored in the run log: counts come from the write itself, a failure is logged and
raised again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadsmith.operators.rejects import enforce, parse_status
from loadsmith.plans.runlog import run_steps
from loadsmith.sinks.publish import write_observed

FILE_NAME = "__FileName"


def document_batches(target: str, schema: str, log_to: str | None = None, package: str = "documents",
                     constraints: dict | None = None):
    """A ``foreachBatch`` function: parse, write good and rejected documents, log.

    ``constraints`` (name -> predicate over the parsed fields) fail the batch if a good document breaks one.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        def load(_shared) -> int:
            parsed = parse_status(batch, "value", schema, [FILE_NAME])
            if constraints:
                parsed = enforce(parsed, {n: F.col("rejected") | p for n, p in constraints.items()})
            done = write_observed(parsed, f"{target}/batch={batch_id}", mode="overwrite", partition_by="rejected",
                                  metrics={"n_rejected": F.count_if("rejected")}, name=f"batch-{uuid.uuid4().hex}")
            return int(done["rows"])

        run_steps(batch.sparkSession, package, [(f"batch {batch_id}", load)], log_to)
    return apply


def start_document_stream(spark: SparkSession, landed: str, target: str, schema: str, checkpoint: str,
                          log_to: str | None = None, constraints: dict | None = None, available_now: bool = True,
                          files_per_batch: int | None = None):
    """Start ingesting the files of ``landed``; with ``available_now`` it takes what is there and stops."""
    reader = spark.readStream.schema("value string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(landed).select("value", F.col("_metadata.file_name").alias(FILE_NAME))
    writer = (lines.writeStream.foreachBatch(document_batches(target, schema, log_to, constraints=constraints))
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_ingested(spark: SparkSession, target: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good documents, rejected ones), each with the file name and the micro-batch."""
    fields = StructType.fromDDL(schema)
    stored = spark.read.schema(
        f"{FILE_NAME} string, {schema}, ErrorCode int, ErrorColumn string, ErrorColumnName string, ErrorMessage string, "
        "ErrorText string, batch bigint, rejected boolean").parquet(target)
    return (stored.filter("not rejected").select(FILE_NAME, "batch", *fields.names),
            stored.filter("rejected").select(FILE_NAME, "batch", "ErrorMessage", "ErrorText"))
