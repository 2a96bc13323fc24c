"""Build-state streams: running latest state, and reactions to state changes.

Each micro-batch writes its own ``batch=<id>`` folder in overwrite mode, so a batch that
is run again after a failure replaces its result instead of adding to it.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shardloom.streaming.intake import NO_AGE


def _stream(spark: SparkSession, path: str, schema: T.StructType | str,
            max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFileAge", NO_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_latest_states(spark: SparkSession, ledger: str, schema: T.StructType | str,
                         checkpoint: str, target: str, order_by: Sequence[str] = ("ts",),
                         max_files: int | None = None) -> StreamingQuery:
    """Latest state per index; the state store holds one row per index name."""
    newest = F.max_by("state", F.struct(*order_by, "state"))
    states = _stream(spark, ledger, schema, max_files).groupBy("idx").agg(newest.alias("state"))

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{target}/batch={batch}")

    return states.writeStream.outputMode("update").foreachBatch(write) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_from_updates(spark: SparkSession, target: str) -> DataFrame:
    """Newest state per index from the update folders."""
    return spark.read.parquet(target).groupBy("idx").agg(
        F.max_by("state", "batch").alias("state"))


def stream_state_events(spark: SparkSession, ledger: str, schema: T.StructType | str,
                        checkpoint: str, target: str, order_by: Sequence[str] = ("ts",),
                        max_files: int | None = None) -> StreamingQuery:
    """React to each state record of an index, in the order of ``order_by``.

    ``deleted`` forgets the index and is only logged; the first other record after that, or
    after none at all, starts a build; a later ``completed`` marks it complete; any other, a
    null state too, is only logged.  What is kept between batches is whether an index is
    open: one key per index in the state store, of which a batch writes only those it
    touches.  The store passes the records through chunk by chunk and remembers the newest
    alone, so that an index with very many records needs no more memory than others; their
    order inside a batch is a window's, which spills.

    ``order_by`` must tell the records of an index apart, and no column may be called
    ``_open``.
    """
    order = list(order_by)
    records = _stream(spark, ledger, schema, max_files).select("idx", "state", *order)
    passed = T.StructType([*records.schema.fields, T.StructField("_open", T.BooleanType())])

    def remember(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        was_open = state.get[0] if state.exists else False
        newest = None
        for chunk in chunks:
            both = chunk if newest is None else pd.concat([newest, chunk], ignore_index=True)
            newest = both.sort_values(order, na_position="first", kind="stable").tail(1)
            yield chunk.assign(_open=was_open)
        if newest is not None:
            last = newest["state"].iloc[0]
            state.update((not (isinstance(last, str) and last.lower() == "deleted"),))

    opened = records.groupBy("idx").applyInPandasWithState(
        remember, passed, "open boolean", "append", GroupStateTimeout.NoTimeout)
    gone = F.coalesce(F.lower("state") == "deleted", F.lit(False))

    def react(rows: DataFrame, batch: int) -> None:
        before = Window.partitionBy("idx").orderBy(*order)
        # the record before decides: an index is open unless it was deleted or never seen
        is_open = F.coalesce(~F.lag(gone).over(before), "_open")
        action = F.when(gone, "log").when(~is_open, "build") \
            .when(F.lower("state") == "completed", "complete").otherwise("log")
        rows.select("idx", "state", *order, action.alias("action")) \
            .write.mode("overwrite").parquet(f"{target}/events/batch={batch}")

    return opened.writeStream.outputMode("append").foreachBatch(react) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
