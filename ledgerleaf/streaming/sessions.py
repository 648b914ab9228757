"""Upload sessions: folders that files of all formats arrive in until a mark or a silence closes them.

Two streams read one growing folder, each with its own checkpoint. The first takes every file's
text or the reason why it has none, and writes it below the number of its batch; a repeated batch
overwrites itself. The second sees names and times only; a stateful operator keeps one small state
per session and closes it. A session's documents count once it is closed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerleaf.sources.files import _name_columns, extracted

FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
TEXTS = "session STRING, path STRING, document_name STRING, modified TIMESTAMP, text STRING, reason STRING, batch BIGINT"
CLOSED = "session STRING, files BIGINT, closed TIMESTAMP, reason STRING, batch BIGINT"


def _arrived(spark: SparkSession, uploads: str, mark: str) -> DataFrame:
    """The files below ``uploads`` as they come; a session is the folder right below it."""
    files = spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", "true").load(uploads)
    depth = len([p for p in uploads.split("://")[-1].split("/") if p])
    parts = F.filter(F.split(F.regexp_replace("path", "^[a-z0-9]+:/*", ""), "/+"), lambda p: p != "")
    # What lies directly in the folder belongs to no session.
    session = F.when(F.size(parts) > depth + 1, F.get(parts, F.lit(depth)))
    named = files.select("path", *_name_columns(), F.col("modificationTime").alias("modified"), "content", session.alias("session"))
    return named.where(F.col("session").isNotNull()).withColumn("mark", F.col("document_name").rlike(mark))


def _by_batch(rows: DataFrame, table: str, state: str) -> None:
    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    stream = rows.writeStream.option("checkpointLocation", state).foreachBatch(store)
    stream.trigger(availableNow=True).start().awaitTermination()


def closing(files: DataFrame, silence: str) -> DataFrame:
    """``session, files, closed, reason`` when a session's mark arrives, or once no file came for ``silence``.

    ``files`` is a stream of ``session, modified, mark``. The silence is measured in the files' own time. A
    session is closed once; what arrives later does not open it again.
    """
    seconds = int(pd.Timedelta(silence).total_seconds())

    def close(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Files so far, when the last one came, whether the session is closed.
        count, last, closed = state.get if state.exists else (0, 0, False)
        out = []
        if state.hasTimedOut:
            if not closed:
                out.append((key[0], count, last + seconds, "silence"))
                closed = True
        else:
            for batch in batches:
                seen = batch["seconds"]
                if not closed and batch["mark"].any():
                    end = int(seen[batch["mark"]].min())
                    out.append((key[0], count, end, "mark"))
                    closed = True
                count += int((~batch["mark"]).sum())
                last = max(last, int(seen.max()))
            out = [(k, count, t, r) for k, _, t, r in out]
        state.update((count, last, closed))
        if not closed:
            state.setTimeoutTimestamp((last + seconds) * 1000)
        if out:
            yield pd.DataFrame(out, columns=["session", "files", "closed", "reason"])

    timed = files.withColumn("seconds", F.unix_seconds("modified")).withWatermark("modified", "0 seconds")
    found = timed.groupBy("session").applyInPandasWithState(
        close, "session string, files long, closed long, reason string", "files long, last long, closed boolean",
        "append", GroupStateTimeout.EventTimeTimeout,
    )
    return found.withColumn("closed", F.timestamp_seconds("closed"))


def ingest_sessions(
    spark: SparkSession, uploads: str, table: str, state: str, profile: str = "none",
    mark: str = r"(?i)^complete(\..*)?$", silence: str = "1 hour",
) -> None:
    """Take all files that arrived below ``uploads`` since the last call, and close the sessions that are due.

    ``mark`` is the pattern of the file name that completes a session; the file needs some content, as Spark's
    readers pass over empty files. A repeated or restarted call takes nothing
    twice. Any number of files and formats; those without a reader are rejected with a reason.
    """
    files = _arrived(spark, uploads, mark)
    texts = files.where(~F.col("mark"))
    read = extracted(texts.select("path", "document_name", "extension", "content", "session", "modified"), profile, ["session", "modified"])
    _by_batch(read.select("session", "path", "document_name", "modified", "text", "reason"), f"{table}/files", f"{state}/files")
    _by_batch(closing(files.select("session", "modified", "mark"), silence), f"{table}/closed", f"{state}/closed")


def closed_sessions(spark: SparkSession, table: str) -> DataFrame:
    """``session, files, closed, reason`` of the sessions closed so far."""
    return spark.read.schema(CLOSED).parquet(f"{table}/closed").drop("batch")


def session_corpus(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame]:
    """``(corpus, rejects)`` of the closed sessions, as the batch reader returns them, with the session.

    A path counts once, as its latest batch read it. A file changed after its session was closed is rejected.
    """
    files = spark.read.schema(TEXTS).parquet(f"{table}/files")
    latest = Window.partitionBy("path").orderBy(F.desc("batch"))
    files = files.withColumn("_place", F.row_number().over(latest)).where("_place = 1")
    ended = closed_sessions(spark, table).select("session", F.col("closed").alias("_closed"))
    rows = files.join(ended, "session")
    late = F.date_trunc("second", F.col("modified")) > F.col("_closed")
    reason = F.when(late, F.lit("after the session was closed")).otherwise(F.col("reason"))
    rows = rows.withColumn("reason", reason)
    corpus = rows.where(F.col("reason").isNull()).select("session", "path", "document_name", "text")
    return corpus, rows.where(F.col("reason").isNotNull()).select("session", "path", "document_name", "reason")
