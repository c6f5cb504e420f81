"""A stream run in the run audit: what arrived, was landed, was seen by the transform and was committed."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.plans.facts import commit, prepare_transform
from tidemark.plans.loads import Audit, LoadResult
from tidemark.sources.store import Warehouse, utc_now
from tidemark.spec import FactSpec
from tidemark.streaming.transform import history_stream, stream_schema

ARRIVED = "arrived"


class _RunListener(StreamingQueryListener):
    """Adds up the metric that the stream observes, and closes the run when its query ends, however it ends.

    A session's listeners hear of all its queries; this one minds the query that bears the run's name.
    """

    def __init__(self, audit: Audit, source_table: str, counts: dict, bounded: bool):
        self.audit, self.source_table, self.counts, self.bounded = audit, source_table, counts, bounded
        self.query_run = None
        self.done = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.audit.run_id:
            self.query_run = event.runId

    def onQueryProgress(self, event) -> None:
        if event.progress.runId == self.query_run:
            seen = event.progress.observedMetrics.get(ARRIVED)
            self.counts["source_n"] += (seen["n"] or 0) if seen is not None else 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.query_run:
            try:
                self.close(event.exception)
            finally:
                self.done.set()

    def close(self, error: str | None) -> None:
        result = LoadResult(**self.counts, bounded=self.bounded, mode="stream")
        if error is None and result.failed_hop() != "none":
            error = "counts do not reconcile"
        status = "succeeded" if error is None else "failed"
        self.audit.finish_table(self.source_table, status, result, error)
        self.audit.finish_run(status, None if error is None else f"tables failed: {self.source_table}")


class AuditedStream:
    """A running stream and its run in the audit."""

    def __init__(self, wh: Warehouse, query: StreamingQuery, listener: _RunListener):
        self._wh, self.query, self._listener = wh, query, listener
        self.run_id = listener.audit.run_id

    def await_termination(self, audit_seconds: float = 120) -> None:
        """Wait for the stream, then for its audit rows. Raises what ended the stream; its run is then a failed one."""
        try:
            self.query.awaitTermination()
        finally:
            written = self._listener.done.wait(audit_seconds)
            self._wh.spark.streams.removeListener(self._listener)
        if not written:
            raise TimeoutError(f"run {self.run_id} has ended without its audit rows")


def audited_stream(wh: Warehouse, spec: FactSpec, checkpoint: str, max_files: int | None = None,
                   clock=utc_now) -> AuditedStream:
    """``stream_transform`` as an audited run: a run row and a table-run row for the history that it consumes.

    source_row_count is observed on the stream and reported by its progress; extracted_row_count is what landed;
    staged_row_count what the transform counted in landing; loaded_row_count what the commits name. Each micro-batch is
    landed first, so that the stream's files are read once, where ``stream_transform`` reads them for every count. A
    batch that is delivered again after its commit counts nothing. A driver that is lost leaves a run that stays
    running, which ``stalled_runs`` lists. Streams read no source: they have no watermark_to.
    """
    schema = stream_schema(wh, spec)
    landing = f"lnd.{spec.target_table.partition('.')[2]}_stream"
    state = wh.fact_state(spec.target_table)
    floor = None if state is None else state.last_loaded_at
    audit = Audit(wh, clock)
    audit.start_run(None, "stream")
    audit.start_table(spec.source_table, floor)
    counts = {"source_n": 0, "extracted_n": 0, "staged_n": 0, "loaded_n": 0}
    listener = _RunListener(audit, spec.source_table, counts, floor is not None)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        state = wh.fact_state(spec.target_table)
        if state is not None and state.stream_id == checkpoint and state.batch_id >= batch_id:
            return
        landed = Observation()
        batch.observe(landed, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(wh.path(landing))
        counts["extracted_n"] += landed.get["n"]
        prepared = prepare_transform(
            wh, spec, history=wh.read(landing, schema), ordered_by_load=True, stream=(checkpoint, batch_id)
        )
        seen = 0 if prepared.row is None else prepared.row["n_batch"]
        counts["staged_n"] += seen
        commit(wh, [prepared])
        counts["loaded_n"] += seen if prepared.row is None else wh.fact_state(spec.target_table).n_batch

    wh.spark.streams.addListener(listener)
    try:
        query = (
            history_stream(wh, spec.source_table, schema, max_files).observe(ARRIVED, F.count(F.lit(1)).alias("n"))
            .writeStream.queryName(audit.run_id).trigger(availableNow=True).option("checkpointLocation", checkpoint)
            .foreachBatch(upsert_batch).start()
        )
    except Exception as e:
        wh.spark.streams.removeListener(listener)
        listener.close(str(e))
        raise
    return AuditedStream(wh, query, listener)
