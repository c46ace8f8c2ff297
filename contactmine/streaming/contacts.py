"""Contacts from pages as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from contactmine.operators.contacts import clean, normalise
from contactmine.plans.contacts import extract_contacts
from contactmine.plans.profiles import SourceProfile
from contactmine.schema import CONTACT_FIELDS
from contactmine.sources.pages import stream_pages
from contactmine.streaming.ledger import commit, committed_rows, is_committed, stream_id


def first_arrivals(
    rows: DataFrame, landed_at: str | None = None, delay: str = "7 days"
) -> DataFrame:
    """The first row of each URL; with a landing time the state is dropped after ``delay``."""
    if landed_at is None:
        return rows.dropDuplicates(["url"])
    return rows.withWatermark(landed_at, delay).dropDuplicatesWithinWatermark(["url"])


def _arrivals(
    pages: DataFrame, profile: SourceProfile, landed_at: str | None, delay: str
) -> DataFrame:
    """Every first arrival of a URL: contact fields, or none, and what went wrong on the page."""
    times = [landed_at] if landed_at else []
    rows = extract_contacts(pages, profile, keep_all=True).select(
        "page_id", "url", *times, *CONTACT_FIELDS, "parse_error"
    )
    return first_arrivals(rows, landed_at, delay)


def arriving_contacts(
    pages: DataFrame, profile: SourceProfile, landed_at: str | None = None, delay: str = "7 days"
) -> DataFrame:
    """Contacts of the first arrival of each URL.

    A page without a keyword counts as seen too, so it takes part in the
    first-arrival test as a row without fields. The fields are read before
    that one stateful step, so html is never shuffled or kept as state.
    """
    rows = _arrivals(pages, profile, landed_at, delay)
    return rows.filter(_GOOD).drop("parse_error")


_BAD = "parse_error IS NOT NULL"
_GOOD = "parse_error IS NULL AND source_url IS NOT NULL"


def start(
    spark: SparkSession,
    incoming: str,
    table: str,
    checkpoint: str,
    profile: SourceProfile,
    max_files_per_trigger: int | None = None,
    landed_at: str | None = None,
    delay: str = "7 days",
    before_commit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Take in what has arrived, append its contacts, stop.

    Any number of streams, each with its own checkpoint, may append to one table.
    A batch is computed once and writes contacts and rejects to folders named by
    the stream's own id (which its checkpoint keeps) and the batch; a row in the
    ledger then commits both. A batch that is run again after a failure overwrites
    its folders and, if the ledger has it already, is left alone. Readers
    (``appended``, ``rejects``) see committed batches only.

    With ``landed_at``, a timestamp column of the pages, a URL is remembered for
    ``delay`` only, and pages that land later than that behind the newest are
    dropped, and counted in ``progress_rows``. ``before_commit`` is called with the
    batch's number between writing and committing.
    """
    pages = stream_pages(spark, incoming, max_files_per_trigger, landed_at)
    root = table.rstrip("/")

    def append(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query_id = stream_id(session, checkpoint)
        if is_committed(session, root, query_id, batch_id):
            return
        folder = f"query_id={query_id}/batch_id={batch_id}"
        rows = batch.persist()
        try:
            contacts = normalise(rows.filter(_GOOD)).drop("parse_error")
            contacts.write.mode("overwrite").parquet(f"{root}/contacts/{folder}")
            rejected(rows).write.mode("overwrite").parquet(f"{root}/rejects/{folder}")
            counts = rows.agg(
                F.count(F.lit(1)).alias("seen"),
                F.count_if(F.expr(_GOOD)).alias("contacts"),
                F.count_if(F.expr(_BAD)).alias("rejects"),
            )
            if before_commit is not None:
                before_commit(batch_id)
            commit(counts, root, query_id, batch_id)
        finally:
            rows.unpersist()

    return (
        _arrivals(pages, profile, landed_at, delay)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def appended(spark: SparkSession, table: str) -> DataFrame:
    """Contacts of all committed batches, with ``query_id`` and ``batch_id``."""
    return committed_rows(spark, table, "contacts")


def rejects(spark: SparkSession, table: str) -> DataFrame:
    """``page_id``, ``url``, ``parse_error`` of pages that could not be read, from committed batches."""
    return committed_rows(spark, table, "rejects")


def compact(appended: DataFrame) -> DataFrame:
    """The de-duplicated table: first by batch, then by stream and page."""
    ordered = appended.withColumn("ingest_ord", F.struct("batch_id", "query_id", "page_id"))
    return clean(ordered).drop("ingest_ord")


def rejected(parsed: DataFrame) -> DataFrame:
    """Pages that could not be parsed, for a reject table."""
    return parsed.filter(_BAD).select("page_id", "url", "parse_error")


def progress_rows(query: StreamingQuery) -> DataFrame:
    """``batch_id``, ``pages``, ``late``: what the query's recent batches read and dropped as too late.

    Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates`` batches.
    A batch without new files only moves the watermark.
    """
    rows = [
        (p.batchId, p.numInputRows, sum(s.numRowsDroppedByWatermark for s in p.stateOperators))
        for p in query.recentProgress
    ]
    session = SparkSession.active()
    return session.createDataFrame(rows, "batch_id long, pages long, late long")


class Progress(StreamingQueryListener):
    """Says how many pages a running stream has taken in, every ``every`` pages."""

    def __init__(self, every: int = 20, report=print) -> None:
        self.every, self.report, self.rows = every, report, 0

    def onQueryStarted(self, event) -> None:
        self.rows = 0

    def onQueryProgress(self, event) -> None:
        before, self.rows = self.rows, self.rows + event.progress.numInputRows
        if self.rows // self.every > before // self.every:
            self.report(f"{self.rows} pages processed")

    def onQueryIdle(self, event) -> None:
        return None

    def onQueryTerminated(self, event) -> None:
        return None
