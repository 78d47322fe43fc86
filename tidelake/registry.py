"""Sources that a lake is fed from: their symbols, age limits, null tolerances, and what may be republished."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Source:
    """One source in one group. symbols: canonical to native names."""

    name: str
    group: str
    symbols: dict[str, str]
    interval: str | None = None
    sla_seconds: int = 3 * 86_400
    null_tolerance: dict[str, float] = field(default_factory=dict)
    redistributable: bool = False
    max_rows_per_call: int | None = None
    description: str = ""

    def __post_init__(self) -> None:
        if not self.symbols:
            raise ValueError(f"{self.name} has no symbols")

    def native(self, symbol: str) -> str:
        """The source's own name of a canonical symbol."""
        if symbol not in self.symbols:
            raise ValueError(f"{self.name} does not map {symbol}")
        return self.symbols[symbol]


class Registry:
    """Sources by group and name; a pair that is there twice raises."""

    def __init__(self, sources: list[Source]) -> None:
        self.sources = {(s.group, s.name): s for s in sources}
        if len(self.sources) != len(sources):
            raise ValueError("a source is registered twice in a group")

    def get(self, group: str, name: str) -> Source:
        if (group, name) not in self.sources:
            raise ValueError(f"unknown source {name} in {group}")
        return self.sources[group, name]

    def frame(self, spark: SparkSession) -> DataFrame:
        """A row for each source: the dimension, and the allowlist where redistributable."""
        rows = [(s.name, s.group, s.interval, len(s.symbols), ", ".join(sorted(s.symbols)), s.sla_seconds, s.redistributable, s.description) for s in self.sources.values()]
        return spark.createDataFrame(rows, "name string, group string, interval string, n_symbols int, symbols string, sla_seconds int, redistributable boolean, description string")

    def declared(self, spark: SparkSession) -> DataFrame:
        """group, source, symbol of every declared series."""
        rows = [(s.group, s.name, symbol) for s in self.sources.values() for symbol in s.symbols]
        return spark.createDataFrame(rows, "group string, source string, symbol string")

    def allowed(self, spark: SparkSession) -> DataFrame:
        """group, source pairs that may be republished."""
        return self.frame(spark).where("redistributable").selectExpr("group", "name AS source")


def dashed_symbol(canonical: str) -> str:
    """BTCUSDT as BTC-USD, for venues that quote dollars with a dash."""
    return f"{canonical.removesuffix('USDT')}-USD" if canonical.endswith("USDT") else canonical


#: Per-column null tolerance of bars.
NO_NULLS = dict.fromkeys(("open", "high", "low", "close", "volume"), 0.0)
