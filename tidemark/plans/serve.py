"""Read paths consumers call: lazy DataFrames, entitlement checked first."""
from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.times import instant
from tidemark.operators import asof as A
from tidemark.operators import bars as B
from tidemark.operators import roll as R
from tidemark.operators import trailing as T
from tidemark.operators.alerts import newest_rows
from tidemark.operators.contract import union_frames
from tidemark.operators.entitlements import NotEntitled, Policy, audit_rows
from tidemark.operators.versions import known_on

EOD_GRAIN = ["exchange", "symbol", "expiry", "trade_date"]


def select_trades(trades: DataFrame, symbol: str, start=None, end=None, *, venue: str,
                  limit: int | None = None) -> DataFrame:
    """Trades of one symbol in ``[start, end)``, ordered by time, then by id and version."""
    rows = trades.where((F.col("symbol") == symbol) & (F.col("venue") == venue))
    if start is not None:
        rows = rows.where(F.col("ts") >= instant(start))
    if end is not None:
        rows = rows.where(F.col("ts") < instant(end))
    rows = rows.orderBy("ts", *(c for c in ("trade_id", "ingested_at", "price", "qty") if c in rows.columns))
    return rows.limit(int(limit)) if limit else rows


def select_eod(eod: DataFrame, symbol: str, start=None, end=None, *, exchange: str) -> DataFrame:
    """End-of-day rows in ``[start, end]``, newest ingest per contract-day."""
    rows = eod.where((F.col("symbol") == symbol) & (F.col("exchange") == exchange))
    if start is not None:
        rows = rows.where(F.col("trade_date") >= F.lit(str(start)[:10]).cast("date"))
    if end is not None:
        rows = rows.where(F.col("trade_date") <= F.lit(str(end)[:10]).cast("date"))
    return B.latest_per_grain(rows, EOD_GRAIN).orderBy("trade_date", "expiry")


def adhoc(spark: SparkSession, tables: dict[str, DataFrame], text: str) -> DataFrame:
    """SQL over named frames."""
    return spark.sql(text, **tables)


def research_frame(decisions: DataFrame, trades: DataFrame, *, window_minutes: int = 30,
                   max_staleness_seconds: float = 60.0) -> DataFrame:
    """As-of price with its age plus trailing volatility, one row per decision."""
    matched = A.with_staleness(A.asof_join(decisions, trades, version="ingested_at"), max_staleness_seconds)
    returns = T.bar_returns(B.ohlcv(trades, "1m"))
    return T.attach_trailing(matched, returns, window_minutes=window_minutes)


def catalog(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and time span per (dataset, symbol)."""
    parts = [
        df.groupBy(F.lit(name).alias("dataset"), "symbol").agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(time).cast("timestamp_ntz").alias("first_event"),
            F.max(time).cast("timestamp_ntz").alias("last_event"))
        for name, (df, time) in tables.items()]
    return union_frames(parts)


class MarketData:
    """The one door for consumers: every read is decided, logged and lazy.

    ``tables`` maps ``trades, eod_bars, contract_reference, contract_specs,
    quality_events, access_log, vendor_scores`` to DataFrames; absent ones are absent.
    ``audit`` receives the log rows; its failure never breaks a read.
    """

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], policy: Policy, *,
                 consumer: str | None = None, now: str, datasets: dict[str, str] | None = None,
                 audit=None):
        self.spark, self.tables, self.policy, self.now = spark, tables, policy, now
        self.consumer = consumer or policy.default_consumer
        self.datasets = datasets or {
            "trades": "ticks", "eod_bars": "eod", "contract_reference": "eod",
            "contract_specs": "eod", "quality_events": "platform_metadata",
            "access_log": "platform_metadata", "vendor_scores": "platform_metadata"}
        self.audit = audit

    def _read(self, table: str) -> DataFrame:
        dataset = self.datasets[table]
        allowed, detail = self.policy.allows(self.consumer, dataset)
        if self.audit is not None:
            row = [(self.consumer, dataset, allowed, detail)]
            try:
                self.audit(audit_rows(self.spark.createDataFrame(
                    row, "consumer string, dataset string, allowed boolean, detail string"),
                    now=self.now))
            except Exception as exc:  # noqa: BLE001 - logging must not stop the read
                warnings.warn(f"access not logged: {exc}", stacklevel=2)
        if not allowed:
            raise NotEntitled(detail)
        return self.tables[table]

    def _trades(self, symbol: str, venue: str) -> DataFrame:
        return self._read("trades").where(
            (F.col("symbol") == symbol) & (F.col("venue") == venue))

    def get_bars(self, symbol, start=None, end=None, freq="1m", *, venue) -> DataFrame:
        return B.ohlcv(self._trades(symbol, venue), freq, start, end)

    def get_trades(self, symbol, start=None, end=None, *, venue, limit=None) -> DataFrame:
        return select_trades(self._read("trades"), symbol, start, end, venue=venue, limit=limit)

    def _asks(self, symbol: str, venue: str, times: DataFrame) -> DataFrame:
        keyed = times.withColumns({"venue": F.lit(venue), "symbol": F.lit(symbol)})
        return A.normalise_decisions(keyed)

    def as_of(self, symbol, times: DataFrame, *, venue, max_staleness_seconds=60.0) -> DataFrame:
        return A.with_staleness(A.asof_join(self._asks(symbol, venue, times), self._trades(symbol, venue),
                                            version="ingested_at"), max_staleness_seconds)

    def research_frame(self, symbol, times: DataFrame, *, venue,
                       vol_window_minutes=30) -> DataFrame:
        return research_frame(self._asks(symbol, venue, times), self._trades(symbol, venue),
                              window_minutes=vol_window_minutes)

    def get_eod(self, symbol, start=None, end=None, *, exchange) -> DataFrame:
        return select_eod(self._read("eod_bars"), symbol, start, end, exchange=exchange)

    def get_continuous(self, symbol, *, exchange, method="volume", adjust="ratio", as_of=None,
                       known_at=None) -> DataFrame:
        """The stored map is used when one was built and held a belief on that date."""
        of = (F.col("symbol") == symbol) & (F.col("exchange") == exchange)
        rows = self._read("eod_bars").where(of)
        if known_at is not None:
            rows = rows.where(F.col("ingested_at") <= instant(known_at))
        stored = None
        if "contract_reference" in self.tables:
            stored = self.tables["contract_reference"].where(of & F.col("is_front"))
            stored = known_on(stored, as_of) if as_of is not None else stored
            stored = None if stored.isEmpty() else stored
        return R.continuous_series(B.latest_per_grain(rows, EOD_GRAIN), method=method,
                                   adjust=adjust, as_of=as_of, roll_map=stored)

    def get_specs(self, symbol, *, exchange, as_of=None) -> DataFrame:
        specs = self._read("contract_specs").where(
            (F.col("symbol") == symbol) & (F.col("exchange") == exchange))
        specs = known_on(specs, as_of) if as_of is not None else specs
        return specs.orderBy(F.desc("known_from")).limit(1)

    def notional(self, symbol, price: float, lots: float = 1.0, *, exchange, as_of=None) -> float:
        spec = self.get_specs(symbol, exchange=exchange, as_of=as_of).first()
        if spec is None or spec["lot_size"] is None:
            raise LookupError(f"lot size of {symbol} on {exchange} unknown as of {as_of}")
        return price * spec["lot_size"] * lots

    def catalog(self) -> DataFrame | None:
        found = {}
        for table, time in (("trades", "ts"), ("eod_bars", "trade_date")):
            try:
                if table in self.tables:
                    found[table] = (self._read(table), time)
            except NotEntitled:
                continue
        return catalog(found) if found else None

    def quality(self, limit: int = 20) -> DataFrame:
        return newest_rows(self._read("quality_events"), limit)

    def access_log(self, limit: int = 20) -> DataFrame:
        return newest_rows(self._read("access_log"), limit)

    def vendor_scores(self) -> DataFrame:
        return self._read("vendor_scores").orderBy(F.desc("as_of"), "source")
