"""The incremental transform as an available-now stream over the history's files."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.facts import commit, prepare_transform
from tidemark.sources.history import read_history
from tidemark.sources.store import Warehouse
from tidemark.spec import FactSpec, LOAD_DATE


def history_stream(wh: Warehouse, table: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    reader = wh.spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(wh.path(table))


def stream_schema(wh: Warehouse, spec: FactSpec) -> T.StructType:
    """The columns that the files of a fact's history hold."""
    history = read_history(wh, spec.source_table)
    if history is None:
        raise ValueError(f"{spec.source_table} has no history yet")
    return T.StructType([f for f in history.schema.fields if f.name != LOAD_DATE])


def stream_transform(wh: Warehouse, spec: FactSpec, checkpoint: str, max_files: int | None = None) -> StreamingQuery:
    """Consume new history files and upsert each micro-batch into the fact.

    The checkpoint takes the place of the loaded_at floor. No event-time watermark is needed: a
    version that arrives late is refused by the upsert. Files may come out of load order, so equal
    modifications are decided by load time. A batch that is delivered again is recognised by its
    number, which is committed with the snapshot.
    """
    schema = stream_schema(wh, spec)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        state = wh.fact_state(spec.target_table)
        if state is not None and state.stream_id == checkpoint and state.batch_id >= batch_id:
            return
        prepared = prepare_transform(
            wh, spec, history=batch, ordered_by_load=True, stream=(checkpoint, batch_id)
        )
        commit(wh, [prepared])

    return (
        history_stream(wh, spec.source_table, schema, max_files)
        .writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
        .foreachBatch(upsert_batch).start()
    )
