"""Table shapes: four bronze groups, tape kinds, violations and quality history."""

from __future__ import annotations

from pyspark.sql import types as T


_LEVELS = "array<array<string>>"
_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(), _LEVELS: T.ArrayType(T.ArrayType(T.StringType())),
}


def _of(columns: str) -> T.StructType:
    """A schema of ``name type`` pairs; unlike a DDL string it needs no session."""
    return T.StructType([T.StructField(n, _TYPES[k]) for n, k in (c.split() for c in columns.split(","))])


BARS = _of("date timestamp, open double, high double, low double, close double, volume double, source string, symbol string, interval string")
SERIES = _of("date timestamp, value double, source string, series_id string, metric string")
EVENTS = _of(
    "event_id string, series_id string, scheduled_ts timestamp, observed_ts timestamp, actual double, forecast double,"
    " previous double, revision_seq int, source string, calendar string"
)
#: Tape kinds; prices and sizes keep the exact digits received.
TAPE = {
    "trades": _of("symbol string, trade_id bigint, price string, quantity string, trade_time string, event_time string, buyer_is_maker boolean, side string, sequence bigint, received_at bigint"),
    "book_ticker": _of("symbol string, bid_price string, bid_qty string, ask_price string, ask_qty string, update_id bigint, price string, last_size string, trade_id bigint, side string, event_time string, received_at bigint"),
    "depth": _of(f"symbol string, first_update_id bigint, final_update_id bigint, bids {_LEVELS}, asks {_LEVELS}, changes {_LEVELS}, event_time string, received_at bigint"),
    "snapshot": _of(f"symbol string, last_update_id bigint, bids {_LEVELS}, asks {_LEVELS}, snapshot_time string, received_at bigint"),
    "gaps": _of("stream_kind string, symbol string, reason string, last_seq bigint, next_seq bigint, missing_count bigint, gap_start_ms bigint, gap_end_ms bigint, duplicates bigint"),
    "session": _of("event string, at_ms bigint, message_count bigint, gap_count bigint"),
    "heartbeat": _of("symbol string, sequence bigint, last_trade_id bigint, heartbeat_time string, received_at bigint"),
}
VIOLATION = _of("group string, source string, series_id string, metric string, check string, severity string, detail string")
DQ_RUNS = _of("run_ts timestamp, run_date string, cadence string, n_violations bigint, n_error bigint, n_warn bigint, groups string, n_updated bigint, n_failed bigint")
#: What a run could not fetch, and registered series that it found the lake not to hold.
DQ_FAILURES = _of("run_ts timestamp, run_date string, cadence string, group string, series string, error string, detail string")
DQ_DRIFT = _of("run_ts timestamp, run_date string, cadence string, group string, source string, symbol string")
DQ_VIOLATIONS = _of("run_ts timestamp, run_date string, cadence string, group string, source string, series_id string, metric string, check string, severity string, detail string")

#: Keys under which a bronze row is unique within its file.
ROW_KEYS = {"bars": ["date"], "series": ["date"], "events": ["event_id", "revision_seq"]}
#: Keys of a whole group's rows.
GROUP_KEYS = {
    "bars": ["source", "symbol", "interval", "date"],
    "series": ["source", "series_id", "metric", "date"],
    "events": ["source", "calendar", "event_id", "revision_seq"],
}
#: Columns without which a frame of a group cannot be judged further.
REQUIRED = {"bars": ["open", "high", "low", "close", "volume"], "series": [], "events": ["event_id", "series_id", "scheduled_ts", "observed_ts", "revision_seq"]}
