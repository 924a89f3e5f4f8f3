"""Commands that arrive as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollbook import schemas
from rollbook.functions.staging import stage, staging_scope
from rollbook.plans import commands as C
from rollbook.sources.store import TableStore

ARRIVED, FILE = "_arrived", "_file"


def apply_batch(
    store: TableStore,
    verb: str,
    commands: DataFrame,
    batch: str,
    as_of: Column | str | None = None,
    order: tuple[str, ...] = ("seq",),
) -> None:
    """Apply one batch of commands to the stored tables unless it has been applied.

    The batch name goes into the manifest together with the rows it wrote, so a
    batch that is played again after a failure changes nothing.  Refused commands
    are set aside in the store.
    """
    if store.has_batch(batch):
        return
    if verb not in schemas.COMMANDS:
        raise ValueError(f"unknown verb {verb}")
    spark = commands.sparkSession
    store = TableStore(spark, store.root)
    with staging_scope(spark):
        tables, ids, calls = store.read(), store.next_ids(), stage(commands)
        changes = None
        if verb == "record_grades":
            # the changes are stored as such, and folded when the table is read
            changes, rejected = C.grade_changes(tables, calls, order)
            added = {"grades": C.new_grades(tables["grades"], changes, ids)}
        else:
            if verb == "add_students":
                done = C.add_students(tables, calls, order, next_ids=ids)
            elif verb == "register_students":
                done = C.register_students(tables, calls, as_of, order, next_ids=ids)
            else:
                done = C.mark_attendance(tables, calls, as_of, order, next_ids=ids)
            rejected, added = done.rejected, done.added
        store.set_aside(rejected, verb, batch)
        store.publish(append=added, changes=changes, batch=batch)


def start_command_stream(
    spark: SparkSession,
    in_dir: str,
    store: TableStore,
    verb: str,
    checkpoint: str,
    as_of: Column | str | None = None,
    available_now: bool = True,
    max_files: int = 1000,
) -> StreamingQuery:
    """Apply command files (JSON lines) of ``in_dir`` as they arrive.

    The state of the commands is the stored tables, so the stream itself keeps
    none.  Commands take effect in the order in which they arrive: by the time
    of their file, then its name, then ``seq``.  Files are taken in that order
    too, so the outcome does not depend on how many make a batch (files of one
    millisecond excepted, which may be taken in any order).
    """
    incoming = (
        spark.readStream.schema(schemas.COMMANDS[verb])
        .option("maxFilesPerTrigger", max_files)
        .json(in_dir)
        .select("*", F.col("_metadata.file_modification_time").alias(ARRIVED), F.col("_metadata.file_path").alias(FILE))
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_batch(store, verb, batch, f"{verb}-{batch_id}", as_of, (ARRIVED, FILE, "seq"))

    writer = incoming.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
