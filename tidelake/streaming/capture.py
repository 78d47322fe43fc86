"""Capture: a replayable message source, the handover filter, sessions that count themselves.

A feed is a log of messages by stream, each message at an offset.  ``feed`` makes it a
streaming source: an offset a stream is what a checkpoint keeps, a batch is cut into
partitions that any task can read again, and what is committed may be dropped by the feed.
``land`` and ``landed`` are a feed of files: segments named by their first offset.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidelake.session import work_path
from tidelake.sources import files
from tidelake.streaming.tape import session_marker, write_tape

MESSAGE = "stream string, offset long, message string, received_at long"
#: Longest wait between attempts at a feed, in seconds, and attempts.
BACKOFF_MOST, ATTEMPTS = 60.0, 8


def backoff(call: Callable[[], object], attempts: int = ATTEMPTS, first: float = 1.0, most: float = BACKOFF_MOST, sleep: Callable[[float], None] = time.sleep) -> object:
    """What call returns; OSErrors are tried again after 1, 2, 4 .. seconds, at most ``most``."""
    for n in range(attempts):
        try:
            return call()
        except OSError:
            if n == attempts - 1:
                raise
        sleep(min(most, first * 2**n))
    raise AssertionError


@dataclass
class Span(InputPartition):
    """Messages first to last (open) of a stream."""

    stream: str
    first: int
    last: int


class _FeedReader(DataSourceStreamReader):
    """Cuts a feed's new messages into batches and these into partitions of bounded size."""

    def __init__(self, oldest, latest, read, committed, per_batch: int, per_task: int) -> None:
        self.oldest, self.latest, self.read_span, self.committed = oldest, latest, read, committed
        self.per_batch, self.per_task = per_batch, per_task
        self.at: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return {k: int(v) for k, v in backoff(self.oldest).items()}

    def latestOffset(self) -> dict:
        """The feed's end, at most ``per_batch`` messages a stream beyond the last batch's."""
        ends = {k: int(v) for k, v in backoff(self.latest).items()}
        if self.at is None:
            self.at = self.initialOffset()
        self.at = {k: max(self.at.get(k, 0), min(end, self.at.get(k, 0) + self.per_batch)) for k, end in ends.items()} | {k: v for k, v in self.at.items() if k not in ends}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = {**(self.at or {}), **{k: max(int(v), (self.at or {}).get(k, 0)) for k, v in end.items()}}  # after a restart the checkpoint says where
        out = []
        for stream, last in sorted(end.items()):
            first = int(start.get(stream, 0))
            out += [Span(stream, a, min(a + self.per_task, int(last))) for a in range(first, int(last), self.per_task)]
        return out

    def read(self, partition: Span) -> Iterator[tuple]:
        n = partition.first
        for offset, message, received_at in backoff(lambda: list(self.read_span(partition.stream, partition.first, partition.last))):
            if offset != n:
                raise ValueError(f"{partition.stream} gave {offset} for {n}")
            yield partition.stream, offset, message, received_at
            n += 1
        if n != partition.last:
            raise ValueError(f"{partition.stream} has no message {n}")

    def commit(self, end: dict) -> None:
        self.committed(end)


def feed(name: str, oldest: Callable[[], dict], latest: Callable[[], dict], read: Callable[[str, int, int], object], committed: Callable[[dict], None] = lambda end: None, per_batch: int = 100_000, per_task: int = 20_000) -> type[DataSource]:
    """A streaming source of MESSAGE rows to register under a name.

    oldest() and latest() give the first offset and the end (open) of each stream;
    read(stream, first, last) gives (offset, message, received_at) of that range, the same
    each time; committed(end) tells what no batch will ask for again.  A range that a feed
    cannot give whole raises, as a silent hole would look like the venue's.
    """

    class Feed(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return MESSAGE

        def streamReader(self, schema) -> DataSourceStreamReader:
            return _FeedReader(oldest, latest, read, committed, int(self.options.get("per_batch", per_batch)), int(self.options.get("per_task", per_task)))

    return Feed


def land(messages: DataFrame, path: str, segment: int = 10_000, order: list[str] | None = None, start: dict[str, int] | None = None) -> int:
    """Writes messages (stream, message, received_at) as segments of a landed feed; how many segments.

    A stream's messages are numbered in ``order`` from its start, in ranges along that order
    whose counts are placed first, so a busy stream is no task's alone.  A segment is
    written beside its name and then renamed, so a reader never sees half of one.
    """
    spark = messages.sparkSession
    order = order or ["received_at"]
    ranged = messages.repartitionByRange("stream", *order).withColumn("piece", F.spark_partition_id())
    at = work_path(spark, "landing")  # ranges are drawn once
    ranged.write.parquet(at)
    ranged = spark.read.schema(ranged.schema).parquet(at)
    ahead = Window.partitionBy("stream").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("stream", "piece").count().select("stream", "piece", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("before"))
    known = F.create_map(*(F.lit(x) for kv in start.items() for x in kv)) if start else None
    first = F.coalesce(F.try_element_at(known, F.col("stream")), F.lit(0)) if known is not None else F.lit(0)
    place = F.row_number().over(Window.partitionBy("stream", "piece").orderBy(*order)) - 1
    rows = ranged.withColumn("place", place).join(before, ["stream", "piece"])
    rows = rows.select("stream", "message", "received_at", (F.col("before") + F.col("place") + first).cast("long").alias("offset"))
    rows = rows.withColumn("segment", F.floor(F.col("offset") / segment))

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        fs, where = files.opened(path)
        pdf = pdf.sort_values("offset")
        stream, at = pdf["stream"].iloc[0], int(pdf["offset"].iloc[0])
        folder = f"{where.rstrip('/')}/{stream.replace('/', '_')}"
        fs.create_dir(folder)
        part, name = f"{folder}/.{at:020d}.tmp", f"{folder}/{at:020d}.jsonl"
        with fs.open_output_stream(part) as out:
            out.write("".join(json.dumps([m, r]) + "\n" for m, r in zip(pdf["message"], pdf["received_at"].tolist())).encode())
        fs.move(part, name)
        return pd.DataFrame({"stream": [stream], "n": [len(pdf)]})

    return rows.groupBy("stream", "segment").applyInPandas(write, "stream string, n long").count()


def landed(name: str, path: str, **limits: int) -> type[DataSource]:
    """The streaming source of a landed feed; segments below the committed offsets may be deleted by whoever lands them."""

    def segments(stream: str) -> list[tuple[int, str]]:
        from pyarrow import fs as afs

        fs, where = files.opened(path)
        found = fs.get_file_info(afs.FileSelector(f"{where.rstrip('/')}/{stream}", allow_not_found=True))
        return sorted((int(f.base_name.split(".")[0]), f.path) for f in found if f.base_name.endswith(".jsonl") and not f.base_name.startswith("."))

    def lines(at: str) -> list[list]:
        fs, _ = files.opened(path)
        with fs.open_input_stream(at) as f:
            return [json.loads(x) for x in f.read().decode().splitlines()]

    def streams() -> list[str]:
        from pyarrow import fs as afs

        fs, where = files.opened(path)
        return [f.base_name for f in fs.get_file_info(afs.FileSelector(where, allow_not_found=True)) if f.type == afs.FileType.Directory]

    def oldest() -> dict:
        return {s: found[0][0] for s in streams() if (found := segments(s))}

    def latest() -> dict:
        return {s: found[-1][0] + len(lines(found[-1][1])) for s in streams() if (found := segments(s))}

    def read(stream: str, first: int, last: int) -> Iterator[tuple]:
        found = segments(stream)
        for (at, file), after in zip(found, [*(a for a, _ in found[1:]), last]):
            if at < last and after > first:
                for n, (message, received_at) in enumerate(lines(file), at):
                    if first <= n < last:
                        yield n, message, received_at

    return feed(name, oldest, latest, read, **limits)


# Handover


_HANDED = "source string, symbol string, kind string, connection int, seq long, received_at long, event string, duplicates long, floor long"


class Handover(StatefulProcessor):
    """One stream's way from a connection to the next.

    The state is the open connection, its last id, whether it was closed, what its
    successor has delivered meanwhile, and, in an overlap, the floor with the duplicates so
    far.  Rows of a successor wait while its predecessor still drains.  Once that is
    closed its last id is the floor: rows at or below it are duplicates, and the micro-batch
    of the first row above it ends the overlap with a handover record.  A handover that comes
    before that ends the one before with its own record.  A shuffle gives a micro-batch's
    rows in any order, so nothing depends on their order within it.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "connection int, position long, closed boolean, floor long, duplicates long, since long")
        self.waiting = handle.getListState("waiting", "connection int, seq long, received_at long, event string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        s = [*(self.state.get() if self.state.exists() else (None, None, False, None, 0, None)), False]  # last: the overlap ends with this micro-batch
        late: list[tuple] = []
        waiting = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        for pdf in rows:  # in the order that they came, an Arrow batch at a time
            out: list[tuple] = []
            for connection, seq, at, event in zip(pdf["connection"].tolist(), pdf["seq"].tolist(), pdf["received_at"].tolist(), pdf["event"].tolist()):
                row = (int(connection), None if seq is None or seq != seq else int(seq), int(at), event)
                if s[0] is None or row[0] > s[0]:
                    waiting.append(row)
                elif row[0] < s[0]:
                    late.append(row)
                else:
                    self._take(key, s, row, out)
            yield _handed(out)
        out = []
        while waiting and (s[0] is None or s[2]):  # the open connection's rows of this micro-batch are done
            after = min(r[0] for r in waiting)
            ready, waiting = [r for r in waiting if r[0] == after], [r for r in waiting if r[0] != after]
            self._open(key, s, after, min(r[2] for r in ready), out)
            for row in ready:
                self._take(key, s, row, out)
        # later than their connection's end: duplicates, or rows that nobody else has brought
        out += [(*key, *row[:3], "message", None, None) for row in late if row[3] != "closed" and (row[1] is None or s[1] is None or row[1] > s[1])]
        if s[6]:
            out.append((*key, s[0], None, s[5], "handover", s[4], s[3]))
            s[3], s[4] = None, 0
        yield _handed(out)
        self.state.update(tuple(s[:6]))
        if waiting:
            self.waiting.put(waiting)
        elif self.waiting.exists():
            self.waiting.clear()

    def _open(self, key, s: list, connection: int, at: int, out: list[tuple]) -> None:
        """Goes on to a connection; its predecessor, if any, is closed, and its last id is the floor."""
        if s[0] is not None and s[3] is not None:
            out.append((*key, s[0], None, s[5], "handover", s[4], s[3]))
        s[:] = [connection, s[1], False, None if s[0] is None else s[1], 0, at, False]

    def _take(self, key, s: list, row: tuple, out: list[tuple]) -> None:
        connection, seq, at, event = row
        if event == "closed":
            s[2] = s[2] or connection == s[0]
            return
        if seq is not None and s[3] is not None:
            if seq <= s[3]:
                s[4] += 1
                return
            s[6] = True
        if seq is not None:
            s[1] = seq if s[1] is None else max(s[1], seq)
        out.append((*key, connection, seq, at, "message", None, None))

    def close(self) -> None:
        pass


def _handed(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in _HANDED.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"connection": "Int32", "seq": "Int64", "received_at": "Int64", "duplicates": "Int64", "floor": "Int64"})


def handed_over(rows: DataFrame) -> DataFrame:
    """A stream without what an overlap brings twice, and a handover record an overlap.

    rows: source, symbol, kind, connection (counting up), seq, received_at, event (message,
    or closed once a connection is drained).  Rows without an id pass, and an overlap goes
    on.  Needs the RocksDB state store.  Of a micro-batch the open connection's rows are
    taken as they come, and those of later ones after them; a stream's first micro-batch is
    held until its first connection is known.
    """
    return rows.groupBy("source", "symbol", "kind").transformWithStateInPandas(Handover(), _HANDED, "append", "none")


# Sessions


class Totals(StreamingQueryListener):
    """Sums of a query's observed metrics over all its batches, each batch once."""

    def __init__(self, name: str) -> None:
        self.name, self.lock = name, threading.Condition()
        self.batches: dict[tuple[str, int], dict[str, int]] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            with self.lock:
                self.batches[str(event.progress.runId), event.progress.batchId] = {k: int(v or 0) for k, v in seen.asDict().items()}

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended.add(str(event.runId))
            self.lock.notify_all()

    def of(self, run: str, wait: float = 30.0) -> dict[str, int]:
        """Sums over a run, once the listener has heard of its end."""
        with self.lock:
            self.lock.wait_for(lambda: run in self.ended, wait)
            own = [m for (r, _), m in self.batches.items() if r == run]
        return {k: sum(m[k] for m in own) for k in {k for m in own for k in m}}


class Capture:
    """A running tape with its session's start and stop rows.

    stop() lets the batch that is running end, or waits for what has arrived if the source
    is quiet, and ends the query however long the source goes on.  The stop row holds the
    rows that were written and the gap records among them, handovers not counted; what is
    not written by then is read again from the checkpoint.
    """

    def __init__(self, rows: DataFrame, path: str, checkpoint: str, sessions: str, at_ms: int, every: str = "30 seconds", gap: Column | None = None) -> None:
        self.spark, self.sessions = rows.sparkSession, sessions
        self.totals = Totals("session")
        self.spark.streams.addListener(self.totals)
        self._mark("start", at_ms, 0, 0)
        counted = rows.observe("session", F.count(F.lit(1)).alias("messages"), F.count_if(gap if gap is not None else F.lit(False)).alias("gaps"))
        self.query = write_tape(counted, path, checkpoint, every)

    def _mark(self, event: str, at_ms: int, messages: int, gaps: int) -> None:
        session_marker(self.spark, event, at_ms, messages, gaps).coalesce(1).write.mode("append").parquet(self.sessions)

    def _settle(self, wait: float) -> None:
        """Until a batch that began after the call has ended, nothing is left to read, or the time is over."""
        seen = lambda: self.query.lastProgress.batchId if self.query.lastProgress else -1
        first, until = seen(), time.monotonic() + wait
        while self.query.isActive and time.monotonic() < until:
            status, ran = self.query.status, seen()
            if ran >= first + 2 or (not status["isTriggerActive"] and not status["isDataAvailable"] and ran > first - 1 and ran >= 0):
                return
            time.sleep(0.05)

    def stop(self, at_ms: int, wait: float = 120.0) -> int:
        """Ends the session; rows written in it."""
        self._settle(wait)
        run = str(self.query.runId)
        self.query.stop()
        sums = self.totals.of(run)
        self.spark.streams.removeListener(self.totals)
        self._mark("stop", at_ms, sums.get("messages", 0), sums.get("gaps", 0))
        return sums.get("messages", 0)


def is_gap(kind: str = "kind", reason: str = "reason") -> Column:
    """Rows that are gap records, handovers not being gaps."""
    return (F.col(kind) == "gaps") & (F.coalesce(F.col(reason), F.lit("")) != "handover")


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE = "spark.sql.streaming.stateStore.providerClass"


def drained(stream: DataFrame, path: str, now: bool = True) -> DataFrame:
    """Runs a stream below path until all that is there is written, with the state store that states need, and reads it back.

    now: the source can end by itself, as files can; others are stopped once they are quiet.
    """
    spark = stream.sparkSession
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, ROCKS)
    try:
        writer = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
        query = (writer.trigger(availableNow=True) if now else writer).start()
        try:
            query.awaitTermination() if now else query.processAllAvailable()
        finally:
            query.stop()
    finally:
        spark.conf.set(_STORE, before) if before else spark.conf.unset(_STORE)
    return spark.read.schema(stream.schema).parquet(f"{path}/out")
