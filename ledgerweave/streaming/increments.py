"""Annotation that goes on where it stopped, as a file stream."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.functions.jsontext import strict_record
from ledgerweave.plans.annotate import annotate, training_records
from ledgerweave.plans.runs import existing_lines
from ledgerweave.schemas import RAW_EXAMPLE
from ledgerweave.sources.jsonl import annotated_questions, read_records
from ledgerweave.sources.questions import Domain
from ledgerweave.sources.shared import remove_dir, shared_dir, write_through
from ledgerweave.sources.sinks import append_raw_examples, append_training_records


#: Keeps a stream's keys on the executors' disks, with changes in the checkpoint.
_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _stream_name(spark: SparkSession, work: str) -> str:
    """The name kept beside the checkpoint; the first run draws it and makes the folders."""
    lines = existing_lines(spark, f"{work}/name")
    row = None if lines is None else lines.first()
    if row is not None:
        return row[0]
    spark.createDataFrame([], "value string").write.mode("overwrite").text(f"{work}/retry/batch=-1")
    name = uuid.uuid4().hex
    spark.createDataFrame([(name,)], "value string").write.mode("overwrite").text(f"{work}/name")
    return name


def _first_of_key(lines: DataFrame, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    """Lines of a stream whose key, or else whose text, has not come before."""
    record = strict_record(F.col("value"), schema.simpleString())
    parts = {f"_k{i}": F.col("_record")[k] for i, k in enumerate(key)}
    parts["_unusable"] = F.when(F.col("_record")["question"].isNull(), F.col("value"))
    return (lines.withColumn("_record", record)
            .select("value", *[c.alias(name) for name, c in parts.items()])
            .dropDuplicates(list(parts)).select("value"))


def _on_disk_state(spark: SparkSession) -> SparkSession:
    """The same session with its own settings, of which the state store is another."""
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return own


def annotate_increments(spark: SparkSession, raw_dir: str, out_dir: str, checkpoint: str,
                        domain: Domain, fn: Callable, tenant: Sequence[T.StructField] = (), *,
                        max_files: int = 100, **options):
    """Starts a query over the raw-example files that are new since the last run.

    It ends when they are used up, ``max_files`` files of either source at a time.  Spark's
    state store, partitioned by key, knows the keys that came before: a batch looks up its
    own keys only, however many there were, and of examples with one key the first that
    is seen counts.  The folder ``work`` in the checkpoint holds the examples whose call
    failed, which the next run reads as its second source, and the unusable lines, equal
    ones once.  Every batch writes folders of its own number and overwrites them when it is
    run again after a failure, so nothing is lost or added twice.  Output that came
    from elsewhere is read once a run, for the questions it has already.

    A checkpoint serves one ``out_dir``.  The number of state partitions is that of shuffle
    partitions in its first run.
    """
    key = [*[f.name for f in tenant], "question"]
    schema = T.StructType([*tenant, *RAW_EXAMPLE.fields])
    work_dir = f"{checkpoint.rstrip('/')}/work"
    name = _stream_name(spark, work_dir)
    mine = f"/stream={name}/"
    lines = existing_lines(spark, out_dir)
    others = None if lines is None else write_through(annotated_questions(
        lines.where(~F.col("_metadata.file_path").contains(mine)), tenant))

    def one(lines: DataFrame, batch: int) -> None:
        part = f"batch={batch}"
        path = shared_dir(spark)            # the state is asked once, so lines are kept first
        work, rejects = read_records(write_through(lines, f"{path}/lines"), schema)
        rejects.write.mode("overwrite").parquet(f"{work_dir}/rejects/{part}")
        annotated = write_through(annotate(work, domain, fn, others, key, **options),
                                  f"{path}/annotated")
        append_training_records(training_records(annotated, domain, key[:-1]),
                                f"{out_dir.rstrip('/')}{mine}{part}", "overwrite")
        annotated = annotated.withColumn("gold_answer", F.coalesce("gold_answer", F.lit("")))
        append_raw_examples(annotated.where("status <> 'ok'").select(*schema.names),
                            f"{work_dir}/retry/{part}", "overwrite")
        remove_dir(spark, path)

    files = _on_disk_state(spark).readStream.option("maxFilesPerTrigger", max_files)
    new = _first_of_key(files.text(raw_dir).select("value"), schema, key)
    # A batch that runs again replaces its failures after the run's files were listed.
    # Failures have passed the state once and do not pass it again.
    failed = (files.option("recursiveFileLookup", True).option("ignoreMissingFiles", True)
              .text(f"{work_dir}/retry"))
    return (new.union(failed).writeStream
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(one).start())


def rejected_lines(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(value, reason) of the lines that the runs of a checkpoint could not use."""
    return (spark.read.schema("value string, reason string, batch long")
            .parquet(f"{checkpoint.rstrip('/')}/work/rejects").select("value", "reason"))
