"""The tape: messages to rows, sequence gaps, anchored depth, overlaps, windows, the sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.schemas import TAPE

#: Kinds by the suffix of a combined stream's name, and by a message's own type.
STREAM_KINDS = {"trade": "trades", "bookTicker": "book_ticker", "depth": "depth"}
TYPE_KINDS = {"match": "trades", "last_match": "trades", "ticker": "book_ticker", "l2update": "depth", "snapshot": "snapshot", "heartbeat": "heartbeat"}


def route(messages: DataFrame, by: str = "stream", strict: bool = True) -> DataFrame:
    """messages with kind. by: the field that tells it, ``stream`` (``btcusdt@trade``) or ``type``.

    Unknown streams raise if strict; otherwise unknown messages are dropped.  A message of
    type ``error``, as of a refused subscription, raises always.
    """
    table = STREAM_KINDS if by == "stream" else TYPE_KINDS
    said = F.get_json_object("message", f"$.{by}")
    name = F.regexp_extract(said, "@([A-Za-z]+)", 1) if by == "stream" else said
    kind = F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), name)
    if strict:
        kind = F.coalesce(kind, F.raise_error(F.concat(F.lit("unknown stream "), F.coalesce(said, F.lit("?")))))
    if by == "type":
        kind = F.when(said == "error", F.raise_error(F.concat(F.lit("feed error "), F.coalesce(F.get_json_object("message", "$.message"), F.lit("?"))))).otherwise(kind)
    return messages.withColumn("kind", kind).where("kind IS NOT NULL")


#: Where each kind's columns are in a combined-stream message's data. The venue's format.
STREAM_FIELDS = {
    "trades": {"symbol": "s", "trade_id": "t", "price": "p", "quantity": "q", "trade_time": "T", "event_time": "E", "buyer_is_maker": "m"},
    "book_ticker": {"symbol": "s", "bid_price": "b", "bid_qty": "B", "ask_price": "a", "ask_qty": "A", "update_id": "u"},
    "depth": {"symbol": "s", "first_update_id": "U", "final_update_id": "u", "event_time": "E", "bids": "b", "asks": "a"},
}
#: Where they are in messages that name their type, whose symbol is a product. The venue's format.
TYPE_FIELDS = {
    "trades": {"symbol": "product_id", "trade_id": "trade_id", "price": "price", "quantity": "size", "side": "side", "trade_time": "time", "sequence": "sequence"},
    "book_ticker": {
        "symbol": "product_id", "bid_price": "best_bid", "bid_qty": "best_bid_size", "ask_price": "best_ask", "ask_qty": "best_ask_size", "update_id": "sequence",
        "price": "price", "last_size": "last_size", "trade_id": "trade_id", "side": "side", "event_time": "time",
    },
    "depth": {"symbol": "product_id", "changes": "changes", "event_time": "time"},
    "snapshot": {"symbol": "product_id", "bids": "bids", "asks": "asks", "snapshot_time": "time"},
    "heartbeat": {"symbol": "product_id", "last_trade_id": "last_trade_id", "sequence": "sequence", "heartbeat_time": "time"},
}
#: Ways to read a venue's messages: the field that routes them, and the fields of each kind.
VENUES = {"stream": STREAM_FIELDS, "type": TYPE_FIELDS}


def canonical_symbol(product: Column) -> Column:
    """BTC-USD as BTCUSDT: what stands before the dash, against USDT."""
    return F.concat(F.split_part(product, F.lit("-"), F.lit(1)), F.lit("USDT"))


def decode(messages: DataFrame, kind: str, by: str = "stream") -> DataFrame:
    """Rows of one kind of routed messages (message, kind, received_at), in the kind's columns that the venue has.

    Prices and sizes stay the exact text received, book levels arrays of texts.  A message
    without a field has null there.
    """
    fields = VENUES[by][kind]
    kinds = {f.name: f.dataType for f in TAPE[kind]}
    raw = {n: "string" if not isinstance(kinds[n], T.ArrayType) else "array<array<string>>" for n in fields}
    body = F.get_json_object("message", "$.data") if by == "stream" else F.col("message")
    cells = F.from_json(body, "map<string,string>")  # names may differ by case alone, which a struct's cannot
    rows = messages.where(F.col("kind") == kind).select(cells.alias("c"), "received_at")
    cell = lambda n: F.try_element_at(F.col("c"), F.lit(fields[n]))
    value = lambda n: F.from_json(cell(n), raw[n]) if raw[n] != "string" else cell(n).cast(kinds[n])
    names = {n: canonical_symbol(cell(n)) if by == "type" and n == "symbol" else value(n) for n in fields}
    return rows.select(*(v.alias(n) for n, v in names.items()), "received_at")


def trades(messages: DataFrame) -> DataFrame:
    """Trade rows of combined-stream messages, prices as the exact text received."""
    return decode(messages, "trades")


def book_snapshot(bodies: DataFrame) -> DataFrame:
    """Snapshot rows of fetched order books. bodies: symbol, body (lastUpdateId, bids, asks), received_at."""
    cells = F.from_json("body", "lastUpdateId bigint, bids array<array<string>>, asks array<array<string>>")
    return bodies.withColumn("c", cells).select("symbol", F.col("c.lastUpdateId").alias("last_update_id"), F.col("c.bids").alias("bids"), F.col("c.asks").alias("asks"), "received_at")


#: Width of the pieces, in units of the first order column, that one busy stream is cut to.
CHUNK = 3_600_000


def _chunk(order: str, width: int) -> Column:
    """Which piece of a stream's order a row is in; nulls come first."""
    return F.coalesce(F.floor(F.col(order) / F.lit(width)), F.lit(-(2**62)))


def sequence_gaps(rows: DataFrame, keys: list[str], order: list[str], start: str = "start_seq", last: str = "end_seq", width: int = CHUNK) -> DataFrame:
    """Jumps of contiguous streams, in the order of arrival; order starts with a number.

    The position is the last row's, even if it went back, so a replayed low id makes the
    next normal one look like a jump.  Rows without an end are not checked.  A stream is
    read in pieces of ``width``; a piece's first row is held to the last row of the piece
    before, which comes from a table of one row a piece.
    """
    checked = rows.where(F.col(last).isNotNull()).withColumn("__chunk", _chunk(order[0], width))
    by = Window.partitionBy(*keys, "__chunk").orderBy(*order)
    tails = checked.groupBy(*keys, "__chunk").agg(F.max_by(last, F.struct(*order)).alias("tail"))
    tails = tails.select(*keys, "__chunk", F.lag("tail").over(Window.partitionBy(*keys).orderBy("__chunk")).alias("__before"))
    checked = checked.withColumns({"__last": F.lag(last).over(by), "__place": F.row_number().over(by)})
    jumps = _same(checked, tails, [*keys, "__chunk"]).withColumn("last_seq", F.when(F.col("__place") == 1, F.col("__before")).otherwise(F.col("__last")))
    jumps = jumps.where(F.col(start) > F.col("last_seq") + 1)
    return jumps.select(*keys, "last_seq", F.col(start).alias("next_seq"), (F.col(start) - F.col("last_seq") - 1).cast("bigint").alias("missing_count"))


def order_breaks(rows: DataFrame, keys: list[str], order: list[str], seq: str = "update_id", width: int = CHUNK) -> DataFrame:
    """Rows of an ordering-only stream whose id is not above all before it; nothing is missing by name.

    Read in pieces as sequence_gaps does.
    """
    cut = rows.withColumn("__chunk", _chunk(order[0], width))
    past = Window.partitionBy(*keys, "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    tops = cut.groupBy(*keys, "__chunk").agg(F.max(seq).alias("top"))
    tops = tops.select(*keys, "__chunk", F.max("top").over(Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("__before"))
    late = _same(cut.withColumn("__top", F.max(seq).over(past)), tops, [*keys, "__chunk"]).withColumn("last_seq", F.greatest("__top", "__before"))
    return late.where(F.col(seq) <= F.col("last_seq")).select(*keys, "last_seq", F.col(seq).alias("next_seq"), F.lit(None).cast("bigint").alias("missing_count"))


def anchored_depth(deltas: DataFrame, snapshots: DataFrame, keys: list[str], width: int = CHUNK) -> DataFrame:
    """Order-book changes held to the snapshots that anchor them.

    deltas: keys, received_at, first_update_id, final_update_id.  snapshots: keys,
    received_at, last_update_id.  Each change gets the last snapshot at or before it:
    anchor_at, anchor_id.  state is unanchored (no snapshot yet), stale (the snapshot holds
    it already), anchor (the first after a snapshot), ok, or gap; missing_count is how many
    updates lack before an anchor or ok row.  Other columns are not returned; of snapshots
    at one time the newest counts.

    A stream is read in pieces of ``width``: the snapshot and the last change that a piece
    starts with come from a table of one row a piece.
    """
    when = "received_at"
    one = snapshots.groupBy(*keys, when).agg(F.max("last_update_id").alias("last_update_id"))
    none = F.lit(None).cast("bigint")
    rows = deltas.select(*keys, when, "first_update_id", "final_update_id", none.alias("last_update_id"), F.lit(1).alias("turn"))
    rows = rows.unionByName(one.select(*keys, when, none.alias("first_update_id"), none.alias("final_update_id"), "last_update_id", F.lit(0).alias("turn")))
    rows = rows.withColumn("__chunk", _chunk(when, width))
    order = [F.col(c).asc_nulls_first() for c in (when, "turn", "final_update_id", "first_update_id")]
    snapshot = F.when(F.col("turn") == 0, F.struct(F.col(when).alias("at"), F.col("last_update_id").alias("id")))
    pieces = rows.groupBy(*keys, "__chunk").agg(F.max(snapshot).alias("s"))
    back = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(*keys, "__chunk", F.last("s", ignorenulls=True).over(back).alias("__before"))
    by = Window.partitionBy(*keys, "__chunk").orderBy(*order)
    rows = rows.withColumn("a", F.last(snapshot, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = _same(rows.where("turn = 1"), pieces, [*keys, "__chunk"]).withColumn("a", F.coalesce("a", "__before")).drop("__before")
    fresh = F.col("a").isNotNull() & ~(F.col("final_update_id") <= F.col("a.id"))
    last = F.struct("a", F.col("final_update_id").alias("final"))
    tails = rows.where(fresh).groupBy(*keys, "__chunk").agg(F.max_by(last, F.struct(when, "final_update_id", "first_update_id")).alias("t"))
    tails = rows.select(*keys, "__chunk").distinct().join(tails, [*keys, "__chunk"], "left")
    tails = tails.select(*keys, "__chunk", F.last("t", ignorenulls=True).over(back).alias("__tail"))
    # of one snapshot in one piece, the last change before that is not stale
    run = Window.partitionBy(*keys, "__chunk", "a").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("past", F.last(F.when(fresh, F.col("final_update_id")), ignorenulls=True).over(run))
    rows = _same(rows, tails, [*keys, "__chunk"])
    past = F.coalesce("past", F.when(F.col("__tail.a") == F.col("a"), F.col("__tail.final")))
    rows = rows.withColumn("past", past)
    lacks = F.greatest(F.col("first_update_id") - F.coalesce("past", "a.id") - 1, F.lit(0).cast("bigint"))
    state = F.when(F.col("a").isNull(), "unanchored").when(~fresh, "stale").when(lacks > 0, "gap").when(F.col("past").isNull(), "anchor").otherwise("ok")
    return rows.select(
        *keys, when, "first_update_id", "final_update_id", F.col("a.at").alias("anchor_at"), F.col("a.id").alias("anchor_id"), state.alias("state"), F.when(fresh, lacks).alias("missing_count")
    )


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left with right's row of the same keys, nulls being equal."""
    named = right.select(*(F.col(k).alias(f"__r_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(named, on).drop(*(f"__r_{k}" for k in keys))


def overlap_counts(rows: DataFrame, floors: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """keys, n_kept, n_duplicates: rows of a new connection that drop_overlap keeps, and that it drops."""
    at = rows.join(floors, keys, "left")
    fresh = F.when(F.col("floor").isNull() | (F.col(seq) > F.col("floor")), F.col(seq))
    return at.groupBy(*keys).agg(F.countDistinct(fresh).alias("n_kept"), (F.count("*") - F.countDistinct(fresh)).alias("n_duplicates"))


def drop_overlap(rows: DataFrame, floors: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Rows of a new connection that the old one had not delivered: ids above its last.

    Within the new connection the first row of an id stays.  floors: keys, floor.
    """
    fresh = rows.join(floors, keys, "left").where(F.col("floor").isNull() | (F.col(seq) > F.col("floor"))).drop("floor")
    return fresh.dropDuplicates([*keys, seq])


def tumbling(rows: DataFrame, keys: list[str], ms: Column, width_ms: int) -> DataFrame:
    """keys, bucket, n: rows in each tumbling window of a millisecond time."""
    bucket = ((ms - F.pmod(ms, F.lit(width_ms))) / F.lit(width_ms)).cast("bigint")
    return rows.groupBy(*keys, bucket.alias("bucket")).agg(F.count("*").alias("n"))


def stream_dedup(rows: DataFrame, seq: str, delay: str = "10 minutes") -> DataFrame:
    """A stream without the rows that overlapping connections deliver twice."""
    timed = rows.withColumn("received_ts", F.timestamp_millis("received_at")).withWatermark("received_ts", delay)
    return timed.dropDuplicatesWithinWatermark(["source", "symbol", "kind", seq])


def write_tape(rows: DataFrame, path: str, checkpoint: str, every: str = "30 seconds"):
    """Starts a query that appends rows below path by source, kind, symbol and day."""
    dated = rows.withColumn("date", F.to_date(F.timestamp_millis("received_at")))
    writer = dated.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.partitionBy("source", "kind", "symbol", "date").trigger(processingTime=every).start()


def session_marker(spark, event: str, at_ms: int, messages: int = 0, gaps: int = 0) -> DataFrame:
    """A start or stop row of a capture session."""
    return spark.createDataFrame([("_all", event, at_ms, messages, gaps)], "symbol string, event string, at_ms bigint, message_count bigint, gap_count bigint")


def reconnect_gaps(positions: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """A gap record for every stream that was being tracked when a connection was lost."""
    return positions.select("source", "symbol", "kind", F.lit("reconnect").alias("reason"), F.col("position").alias("last_seq"), F.lit(start_ms).cast("bigint").alias("gap_start_ms"), F.lit(end_ms).cast("bigint").alias("gap_end_ms"))
