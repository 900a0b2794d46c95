"""

Every query reads the driver's tables through ``tickwise.sources.adapters``
(market model mapped on to the TPC-H-ish tables + ``events``) and runs over
whole tables. ``oracle_sql`` holds the equivalent DuckDB SQL, written
independently of the Spark code from the same mapping.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.prices import bar_pct_change, tick_pct_change
from tickwise.operators import checks as C
from tickwise.operators import reports as R
from tickwise.operators.bars import daily_bars
from tickwise.operators.decode import decode_ticks, parse_envelopes
from tickwise.operators.encode import RECORD_TICKS, encode_snapshots
from tickwise.operators.keycheck import stored_conflicts
from tickwise.operators.snapshot import last_updated, market_snapshot
from tickwise.operators.ticks import (
    closing_ticks, session_scan, session_ticks, tick_rejects, unknown_symbols,
)
from tickwise.plans.daily_report import daily_report
from tickwise.plans.incremental import incremental_bars, read_backlog
from tickwise.schemas import TICK_FIELDS
from tickwise.session import checkpoint_root
from tickwise.sinks.counts import COUNTS, read_counts
from tickwise.sinks.prices import upsert_bars
from tickwise.sinks.quarantine import PLACE, read_quarantine, replay_quarantine
from tickwise.sinks.ticks import compact_ticks, write_tick_batch
from tickwise.sources import adapters as A
from tickwise.sources.seed import assign_ids
from tickwise.sources.streams import text_envelope_stream
from tickwise.sources.tables import preview, read_prices, read_ticks
from tickwise.streaming.ingest import ingest_ticks

# The text operators live in a subpackage of their own and in corpus_pipeline;
# without these two the rest is complete.
LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}
try:
    from tickwise.llm import queries as _llm

    LLM_QUERIES |= _llm.QUERIES
    LLM_ORACLES |= _llm.ORACLES
    import corpus_pipeline as _pipeline

    LLM_QUERIES["pipeline"] = _pipeline.run
    if _pipeline.ORACLE_SQL:
        LLM_ORACLES["pipeline"] = _pipeline.ORACLE_SQL
except ModuleNotFoundError as e:
    # they or a library that only they use may be missing; a missing part of the rest is an error
    if (e.name or "").startswith("tickwise") and not e.name.startswith("tickwise.llm"):
        raise
    LLM_QUERIES.clear()
    LLM_ORACLES.clear()

SMOKE_DIR = "/root/testdata/sf0.001"

# Report date used against the driver's tables (the busiest bar day at sf0.01)
# and the first trade date of the incremental re-run in ``upsert_bars``.
REPORT_DATE = "2024-01-22"
RERUN_FROM = "2024-01-10"
EARLY_OPEN = "12:00:00"
# Symbol of the one-symbol session scan (SRC-4): the busiest listed symbol of
# the report date at sf0.01.
SCAN_SYMBOL = "S43"


def _dims(spark: SparkSession, sf_dir: str):
    return (A.ticks(spark, sf_dir), A.companies(spark, sf_dir))


def q_daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the prices view is exactly the bar job over the whole tick view
    return A.prices(spark, sf_dir).select("*")


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for what a query writes and reads back."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")


def q_upsert_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the whole history, then a re-run of the recent trade dates.

    The first run takes a session from ``EARLY_OPEN``, so that its highs and lows
    differ from the re-run's. Both go through the sink; the result is what the
    stored table then holds.
    """
    t, c = _dims(spark, sf_dir)
    path = _scratch(spark, "prices")
    upsert_bars(spark, daily_bars(t, c, EARLY_OPEN), path)
    rerun = daily_bars(t.filter(F.col("trade_date") >= F.lit(RERUN_FROM).cast("date")), c)
    upsert_bars(spark, rerun, path, c)
    return read_prices(spark, path)


def q_daily_report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five CSVs of one date, written and read back as (report, label, symbol, value)."""
    p, c = _report_inputs(spark, sf_dir)
    paths = daily_report(p, c, A.sectors(spark, sf_dir), A.exchanges(spark, sf_dir), REPORT_DATE,
                         _scratch(spark, "reports"))
    out = None
    for name, path in paths.items():
        rows = spark.read.option("header", True).csv(path)
        symbol = F.col("symbol") if "symbol" in rows.columns else F.lit(None).cast("string")
        one = rows.select(F.lit(name).alias("report"), F.col(rows.columns[0]).alias("label"),
                          symbol.alias("symbol"), F.col(rows.columns[-1]).cast("decimal(38,2)").alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


def q_ingested_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ticks as envelopes in text files, ingested by the streaming query and read from the store.

    A second query on a checkpoint of its own reads the source from the start again;
    the store's ledger keeps it from adding any tick twice.
    """
    t, _ = _dims(spark, sf_dir)
    source, store = _scratch(spark, "envelopes"), _scratch(spark, "store")
    # the source reads a file as one text
    encode_snapshots(t, max_ticks=RECORD_TICKS).select("value").write.option("maxRecordsPerFile", 64).text(source)
    for _ in range(2):
        ingest_ticks(text_envelope_stream(spark, source), store, _scratch(spark, "ingest"),
                     available_now=True).awaitTermination()
    return read_ticks(spark, store).select(*TICK_FIELDS, "trade_date")


def q_repaired_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ticks as envelopes, some of which arrive torn, are put in quarantine, repaired and replayed.

    The repair is replayed twice and the source read once more afterwards; each tick is stored once.
    """
    t, _ = _dims(spark, sf_dir)
    source, store = _scratch(spark, "envelopes"), _scratch(spark, "store")
    value, torn = F.col("value"), F.pmod(F.xxhash64("value"), F.lit(3)) == 0
    (encode_snapshots(t, max_ticks=RECORD_TICKS)
        .select(F.when(torn, value.substr(F.lit(1), F.length("value") - 1)).otherwise(value).alias("value"))
        .write.option("maxRecordsPerFile", 64).text(source))

    def ingest() -> None:
        ingest_ticks(text_envelope_stream(spark, source), store, _scratch(spark, "ingest"),
                     available_now=True).awaitTermination()

    ingest()
    repaired = read_quarantine(spark, store).filter("reason = 'not JSON'").select(
        *PLACE, F.concat(F.col("value").cast("string"), F.lit("]")).alias("value")).checkpoint()
    for _ in range(2):
        replay_quarantine(spark, store, repaired)
    ingest()
    return read_ticks(spark, store).select(*TICK_FIELDS, "trade_date")


def q_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-7: the kept counts of all batches of an ingest through two checkpoints, summed up."""
    t, _ = _dims(spark, sf_dir)
    source, store = _scratch(spark, "envelopes"), _scratch(spark, "store")
    encode_snapshots(t, max_ticks=RECORD_TICKS).select("value").write.option("maxRecordsPerFile", 64).text(source)
    for _ in range(2):
        ingest_ticks(text_envelope_stream(spark, source), store, _scratch(spark, "ingest"),
                     available_now=True).awaitTermination()
    return read_counts(spark, store).agg(*[F.sum(c).alias(c) for c in COUNTS])


def _land(t: DataFrame, k: int, n: int, store: str) -> None:
    """Land part ``k`` of ``n`` of the ticks, dealt by hash, so that batches are out of order."""
    part = t.filter(F.pmod(F.xxhash64("seq"), F.lit(n)) == k)
    write_tick_batch(part.select(*TICK_FIELDS, "seq"), k, store, "feed")


def q_incremental_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars kept up to date from new batches only, over out-of-order batches and a compaction."""
    t, c = _dims(spark, sf_dir)
    store, state, path = (_scratch(spark, n) for n in ("store", "state", "prices"))
    for k in range(3):
        _land(t, k, 3, store)
        if k == 1:
            compact_ticks(spark, store)
        incremental_bars(spark, store, state, path, c)
    return read_prices(spark, path)


def q_late_listed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars after half of the companies were listed only when all ticks had been folded."""
    t, c = _dims(spark, sf_dir)
    store, state, path = (_scratch(spark, n) for n in ("store", "state", "prices"))
    _land(t, 0, 1, store)
    incremental_bars(spark, store, state, path, c.filter("id % 2 = 0"))
    incremental_bars(spark, store, state, path, c)  # no new tick: the backlog alone
    return read_prices(spark, path)


def q_unlisted_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, date) of the bar states that wait for their symbol to be listed."""
    t, c = _dims(spark, sf_dir)
    store, state, path = (_scratch(spark, n) for n in ("store", "state", "prices"))
    _land(t, 0, 1, store)
    incremental_bars(spark, store, state, path, c)
    return read_backlog(spark, state)


def q_envelope_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and ticks of every poll; each is one record, so it must fit a value of 2 GB."""
    t, _ = _dims(spark, sf_dir)
    records = parse_envelopes(encode_snapshots(t))
    return records.groupBy(F.col("envelope_timestamp").alias("timestamp")).agg(
        F.count(F.lit(1)).alias("n_records"), F.sum(F.size("data")).alias("n_ticks"))


def q_dirty_tick_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = tick_rejects(A.dirty_ticks(spark, sf_dir), A.companies(spark, sf_dir))
    return rejects.select("seq", "symbol", "timestamp", "reject_reason")


def q_dirty_daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_bars(A.dirty_ticks(spark, sf_dir), A.companies(spark, sf_dir))


def _report_inputs(spark: SparkSession, sf_dir: str):
    return A.prices(spark, sf_dir), A.companies(spark, sf_dir)


def q_top_volume(spark, sf_dir):
    p, c = _report_inputs(spark, sf_dir)
    return R.top_volume(p, c, REPORT_DATE)


def q_top_gainers(spark, sf_dir):
    p, c = _report_inputs(spark, sf_dir)
    return R.top_gainers(p, c, REPORT_DATE)


def q_top_losers(spark, sf_dir):
    p, c = _report_inputs(spark, sf_dir)
    return R.top_losers(p, c, REPORT_DATE)


def q_avg_close_by_sector(spark, sf_dir):
    p, c = _report_inputs(spark, sf_dir)
    return R.avg_close_by_sector(p, c, A.sectors(spark, sf_dir), REPORT_DATE)


def q_volume_by_exchange(spark, sf_dir):
    p, c = _report_inputs(spark, sf_dir)
    return R.volume_by_exchange(p, c, A.exchanges(spark, sf_dir), REPORT_DATE)


def q_market_snapshot(spark, sf_dir):
    t, c = _dims(spark, sf_dir)
    return market_snapshot(t, c)


def q_market_last_updated(spark, sf_dir):
    return last_updated(q_market_snapshot(spark, sf_dir))


def q_unknown_symbols(spark, sf_dir):
    t, c = _dims(spark, sf_dir)
    return unknown_symbols(t, c).select("seq", "symbol", "timestamp")


def q_tick_rejects(spark, sf_dir):
    t, c = _dims(spark, sf_dir)
    return tick_rejects(t, c).select("seq", "symbol", "reject_reason")


def q_session_scan(spark, sf_dir):
    t, _ = _dims(spark, sf_dir)
    return session_ticks(t).select("symbol", "trade_date", "seq", "current_price")


def q_symbol_session_scan(spark, sf_dir):
    t, _ = _dims(spark, sf_dir)
    return session_scan(t, SCAN_SYMBOL, REPORT_DATE).select(
        "symbol", "timestamp", "seq", "current_price", "volume")


def q_closing_ticks(spark, sf_dir):
    t, _ = _dims(spark, sf_dir)
    return closing_ticks(t).select("seq", "symbol", "timestamp", "open", "current_price")


def q_tick_pct_change(spark, sf_dir):
    t, _ = _dims(spark, sf_dir)
    return t.select("seq", "symbol", tick_pct_change("current_price", "open").alias("pct_change"))


def q_bar_pct_change(spark, sf_dir):
    p = q_daily_bars(spark, sf_dir)
    return p.select("company_id", "date", bar_pct_change("close", "open").alias("pct_change"))


def q_companies_projection(spark, sf_dir):
    return A.companies(spark, sf_dir).select("id", "symbol", "name")


def q_seed_ids(spark, sf_dir):
    events = A.table(spark, sf_dir, "events").select("event_id", "ts")
    return assign_ids(events, ["ts", "event_id"]).select("id", "event_id")


def q_check_not_null(spark, sf_dir):
    t, _ = _dims(spark, sf_dir)
    return C.check_not_null(t, ["symbol", "timestamp", "name"]).select(
        "seq", "symbol", "name", "null_columns")


def q_check_unique(spark, sf_dir):
    t, _ = _dims(spark, sf_dir)
    return C.check_unique(t, ["symbol", "timestamp"])


def q_check_primary_key(spark, sf_dir):
    t, _ = _dims(spark, sf_dir)
    return C.check_primary_key(closing_ticks(t), ["symbol", "trade_date"])


def q_stored_conflicts(spark, sf_dir):
    # the dirty ticks as new rows: their readable keys against the stored ticks
    t, _ = _dims(spark, sf_dir)
    return stored_conflicts(A.dirty_ticks(spark, sf_dir), t, ["symbol", "timestamp"])


def q_check_foreign_key(spark, sf_dir):
    return C.check_foreign_key(A.table(spark, sf_dir, "events"), "user_id",
                               A.table(spark, sf_dir, "supplier"), "s_suppkey")


def q_envelope_roundtrip(spark, sf_dir):
    t, _ = _dims(spark, sf_dir)
    return decode_ticks(encode_snapshots(t, max_ticks=RECORD_TICKS))


def q_preview(spark, sf_dir):
    t, _ = _dims(spark, sf_dir)
    return preview(t).select("symbol", "timestamp", "current_price")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: all daily bars at sf0.001."""
    return q_daily_bars(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "daily_bars": q_daily_bars,
        "upsert_bars": q_upsert_bars,
        "top_volume": q_top_volume,
        "top_gainers": q_top_gainers,
        "avg_close_by_sector": q_avg_close_by_sector,
        "volume_by_exchange": q_volume_by_exchange,
        "top_losers": q_top_losers,
        "market_snapshot": q_market_snapshot,
        "market_last_updated": q_market_last_updated,
        "unknown_symbols": q_unknown_symbols,
        "tick_rejects": q_tick_rejects,
        "session_scan": q_session_scan,
        "symbol_session_scan": q_symbol_session_scan,
        "closing_ticks": q_closing_ticks,
        "tick_pct_change": q_tick_pct_change,
        "bar_pct_change": q_bar_pct_change,
        "companies_projection": q_companies_projection,
        "seed_ids": q_seed_ids,
        "check_not_null": q_check_not_null,
        "check_unique": q_check_unique,
        "check_primary_key": q_check_primary_key,
        "check_foreign_key": q_check_foreign_key,
        "stored_conflicts": q_stored_conflicts,
        "envelope_roundtrip": q_envelope_roundtrip,
        "preview": q_preview,
        "envelope_records": q_envelope_records,
        "ingested_ticks": q_ingested_ticks,
        "repaired_ingest": q_repaired_ingest,
        "batch_counts": q_batch_counts,
        "daily_report_csv": q_daily_report_csv,
        "dirty_tick_rejects": q_dirty_tick_rejects,
        "dirty_daily_bars": q_dirty_daily_bars,
        "incremental_bars": q_incremental_bars,
        "late_listed_bars": q_late_listed_bars,
        "unlisted_backlog": q_unlisted_backlog,
        **LLM_QUERIES,
    }


# ---------------------------------------------------------------- DuckDB oracle

_TICKS = """
t AS (
  SELECT CAST(e.event_id AS DECIMAL(38,0)) AS seq,
         e.user_id,
         'S' || CAST(e.user_id AS VARCHAR) AS symbol,
         s.s_name AS name,
         e.value AS current_price,
         CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS volume,
         date_trunc('hour', e.ts) AS ts,
         strftime(date_trunc('hour', e.ts), '%Y-%m-%d %H:%M:%S') AS timestamp,
         CAST(date_trunc('hour', e.ts) AS DATE) AS trade_date,
         first_value(e.value) OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) AS open
  FROM events e LEFT JOIN supplier s ON s.s_suppkey = e.user_id)"""

_COMPANIES = """
companies AS (
  SELECT s_suppkey AS id, 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, s_name AS name,
         s_nationkey AS sector_id, n_regionkey AS exchange_id
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""

_PRICES = """
bars AS (
  SELECT symbol, CAST(ts AS DATE) AS date,
         arg_max(open, seq) FILTER (WHERE hour(ts) = 18) AS open_raw,
         arg_max(current_price, seq) FILTER (WHERE hour(ts) = 18) AS close_raw,
         max(current_price) AS high_raw,
         min(current_price) AS low_raw,
         max(CAST(trunc(volume) AS BIGINT)) AS volume,
         count(*) FILTER (WHERE hour(ts) = 18) AS marks
  FROM t WHERE hour(ts) BETWEEN 8 AND 18
  GROUP BY symbol, CAST(ts AS DATE)),
prices AS (
  SELECT c.id AS company_id, b.date,
         CAST(b.open_raw AS DECIMAL(10,2)) AS open,
         CAST(b.high_raw AS DECIMAL(10,2)) AS high,
         CAST(b.low_raw AS DECIMAL(10,2)) AS low,
         CAST(b.close_raw AS DECIMAL(10,2)) AS close,
         b.volume
  FROM bars b JOIN companies c ON c.symbol = b.symbol
  WHERE b.marks > 0)"""

_WITH_TICKS = "WITH " + _TICKS + ",\n" + _COMPANIES + "\n"
_WITH_PRICES = "WITH " + _TICKS + ",\n" + _COMPANIES + ",\n" + _PRICES + "\n"

_INGESTED = _WITH_TICKS + """
SELECT current_price, CAST(user_id AS INTEGER) AS id, name, open,
       ROUND((current_price - open) / NULLIF(open, 0) * 100, 2) AS percent_change,
       symbol, timestamp, volume, trade_date
FROM t"""

# The reports over the bars of one day, joined to their companies.
_REPORT_SQL = {
    "top_volume": "SELECT name, symbol, volume FROM day ORDER BY volume DESC NULLS FIRST, symbol LIMIT 5",
    "top_gainers": "SELECT name, symbol, pct_change FROM day ORDER BY pct_change DESC NULLS FIRST, symbol LIMIT 5",
    "avg_close_by_sector": """
SELECT n_name AS sector, CAST(round(avg(close), 2) AS DECIMAL(18,2)) AS avg_close
FROM day JOIN nation ON n_nationkey = sector_id GROUP BY ALL""",
    "volume_by_exchange": """
SELECT r_name AS exchange, CAST(sum(volume) AS DECIMAL(38,0)) AS total_volume
FROM day JOIN region ON r_regionkey = exchange_id GROUP BY ALL""",
    "top_losers": """
SELECT name, symbol, pct_change FROM day WHERE open > 0 AND open > close
ORDER BY pct_change NULLS LAST, symbol LIMIT 5""",
}
_REPORT_FILES = [
    ("top_volume_companies", "top_volume", "name", "symbol", "volume"),
    ("top_gainer_companies", "top_gainers", "name", "symbol", "pct_change"),
    ("avg_close_by_sector", "avg_close_by_sector", "sector", "NULL", "avg_close"),
    ("total_volume_by_exchange", "volume_by_exchange", "exchange", "NULL", "total_volume"),
    ("top_loser_companies", "top_losers", "name", "symbol", "pct_change"),
]


def _bars_of(name: str, ticks: str, open_hour: int = 8) -> str:
    """A common table ``name`` with the daily bars of the ticks that ``ticks`` selects."""
    return f"""
{name} AS (
  SELECT id AS company_id, trade_date AS date,
         CAST(arg_max(open, seq) FILTER (WHERE hour(ts) = 18) AS DECIMAL(10,2)) AS open,
         CAST(max(current_price) AS DECIMAL(10,2)) AS high, CAST(min(current_price) AS DECIMAL(10,2)) AS low,
         CAST(arg_max(current_price, seq) FILTER (WHERE hour(ts) = 18) AS DECIMAL(10,2)) AS close,
         max(CAST(trunc(volume) AS BIGINT)) AS volume
  FROM ({ticks}) x JOIN companies c ON c.symbol = x.symbol
  WHERE hour(ts) BETWEEN {open_hour} AND 18
  GROUP BY ALL HAVING count(*) FILTER (WHERE hour(ts) = 18) > 0)
"""


# The rules by which the adapter spoils ticks, and what a load must say of them.
_DIRTY = _WITH_TICKS + """,
dirty AS (
  SELECT seq, CASE WHEN seq % 13 <> 0 THEN symbol END AS symbol,
         CASE seq % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '2' || timestamp
           WHEN 3 THEN substr(timestamp, 3) WHEN 4 THEN replace(timestamp, ' ', 'T')
           WHEN 5 THEN '2024-02-30' || substr(timestamp, 11) WHEN 6 THEN replace(timestamp, '-0', '-')
           ELSE timestamp END AS timestamp,
         CASE WHEN seq % 19 = 0 THEN 1e9 WHEN seq % 23 <> 0 THEN current_price END AS current_price,
         CASE WHEN seq % 7 = 1 THEN 0 WHEN seq % 7 <> 0 THEN open END AS open,
         CASE WHEN seq % 29 = 0 THEN 1e19 WHEN seq % 31 <> 0 THEN volume END AS volume
  FROM t),
timed AS (
  SELECT *, CASE WHEN regexp_full_match(timestamp, '[0-9]{4}-[0-9]+-[0-9]+ [0-9]+:[0-9]+:[0-9]+')
                 THEN try_strptime(timestamp, '%Y-%m-%d %H:%M:%S') END AS time
  FROM dirty),
judged AS (
  SELECT *, CASE
      WHEN symbol IS NULL THEN 'no_symbol'
      WHEN coalesce(timestamp, '') = '' THEN 'missing_timestamp'
      WHEN time IS NULL THEN 'bad_timestamp'
      WHEN abs(coalesce(current_price, 0)) >= 1e8 OR abs(coalesce(open, 0)) >= 1e8 THEN 'price_out_of_range'
      WHEN abs(coalesce(volume, 0)) >= 9e18 THEN 'volume_out_of_range'
      WHEN NOT EXISTS (SELECT 1 FROM companies c WHERE c.symbol = timed.symbol) THEN 'unknown_symbol' END AS reason
  FROM timed)
"""

_PCT = "CAST(ROUND(((p.close - p.open) / NULLIF(p.open, 0)) * 100, 2) AS DECIMAL(18,2))"

_SNAPSHOT = _WITH_TICKS + """,
l AS (
  SELECT symbol,
         arg_max(open, seq) AS open,
         arg_max(current_price, seq) AS current_price,
         arg_max(ROUND((current_price - open) / NULLIF(open, 0) * 100, 2), seq) AS percent_change,
         arg_max(volume, seq) AS volume,
         arg_max(ts, seq) AS ts
  FROM t WHERE symbol IS NOT NULL GROUP BY symbol)
SELECT l.symbol, c.name, l.open, l.current_price, l.percent_change, l.volume,
       strftime(l.ts, '%Y-%m-%d %H:%M:%S') AS timestamp,
       printf('$%.2f', l.open) AS open_display,
       printf('$%.2f', l.current_price) AS price_display,
       printf('%.2f%%', l.percent_change) AS change_display,
       regexp_replace(regexp_replace(format('{:,.3f}', l.volume), '0+$', ''), '\\.$', '')
         AS volume_display,
       CASE WHEN coalesce(l.percent_change, -1) >= 0 THEN 'positive' ELSE 'negative' END AS change_class
FROM l JOIN companies c ON c.symbol = l.symbol"""


def oracle_sql() -> dict[str, str]:
    day = _WITH_PRICES + f""",
day AS (
  SELECT name, symbol, sector_id, exchange_id, open, close, volume,
         CAST(round(100 * (close - open) / nullif(open, 0), 2) AS DECIMAL(18,2)) AS pct_change
  FROM companies JOIN prices ON company_id = id AND date = '{REPORT_DATE}')
"""
    return {
        "daily_bars": _WITH_PRICES + "SELECT * FROM prices",
        "upsert_bars": _WITH_TICKS + f""",
{_bars_of("early", "SELECT * FROM t", 12)},
{_bars_of("late", f"SELECT * FROM t WHERE trade_date >= '{RERUN_FROM}'")}
SELECT * FROM late
UNION ALL
SELECT * FROM early e
WHERE NOT EXISTS (SELECT 1 FROM late l WHERE l.company_id = e.company_id AND l.date = e.date)""",
        "incremental_bars": _WITH_TICKS + ", " + _bars_of("every", "SELECT * FROM t") + "SELECT * FROM every",
        "late_listed_bars": _WITH_TICKS + ", " + _bars_of("every", "SELECT * FROM t") + "SELECT * FROM every",
        "unlisted_backlog": _WITH_TICKS + """
SELECT DISTINCT symbol, trade_date AS date FROM t
WHERE hour(ts) BETWEEN 8 AND 18 AND NOT EXISTS (SELECT 1 FROM companies c WHERE c.symbol = t.symbol)""",
        "daily_report_csv": day + "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{name}' AS report, CAST({label} AS VARCHAR) AS label, {symbol} AS symbol, "
            f"CAST({value} AS DECIMAL(38,2)) AS value FROM ({_REPORT_SQL[kind]})"
            for name, kind, label, symbol, value in _REPORT_FILES) + ")",
        "preview": _WITH_TICKS + "SELECT symbol, timestamp, current_price FROM t ORDER BY seq LIMIT 1",
        "envelope_records": _WITH_TICKS + """
SELECT timestamp, CAST(1 AS BIGINT) AS n_records, count(*) AS n_ticks FROM t GROUP BY timestamp""",
        "ingested_ticks": _INGESTED,
        "repaired_ingest": _INGESTED,
        "batch_counts": _WITH_TICKS + f"""
SELECT CAST(count(DISTINCT (ts, CAST(seq AS BIGINT) // {RECORD_TICKS})) AS BIGINT) AS envelopes, CAST(0 AS BIGINT) AS malformed,
       count(*) AS ticks
FROM t""",
        "dirty_tick_rejects": _DIRTY + """
SELECT seq, symbol, timestamp, reason AS reject_reason FROM judged WHERE reason IS NOT NULL""",
        "dirty_daily_bars": _DIRTY + ", " + _bars_of("found", """
SELECT seq, symbol, time AS ts, CAST(time AS DATE) AS trade_date, coalesce(open, 0) AS open,
       coalesce(current_price, 0) AS current_price, coalesce(volume, 0) AS volume
FROM judged WHERE reason IS NULL OR reason = 'unknown_symbol'""") + "SELECT * FROM found",
        **{name: day + sql for name, sql in _REPORT_SQL.items()},
        "market_snapshot": _SNAPSHOT,
        "market_last_updated": "WITH snap AS (" + _SNAPSHOT + """)
SELECT 'Last Updated: ' || max(timestamp) || ' UTC' AS last_updated FROM snap""",
        "unknown_symbols": _WITH_TICKS + """
SELECT seq, symbol, timestamp FROM t
WHERE NOT EXISTS (SELECT 1 FROM companies c WHERE c.symbol = t.symbol)""",
        "tick_rejects": _WITH_TICKS + """
SELECT seq, symbol, 'unknown_symbol' AS reject_reason FROM t
WHERE NOT EXISTS (SELECT 1 FROM companies c WHERE c.symbol = t.symbol)""",
        "session_scan": _WITH_TICKS + """,
marks AS (SELECT DISTINCT symbol, trade_date FROM t WHERE hour(ts) = 18)
SELECT t.symbol, t.trade_date, t.seq, t.current_price
FROM t JOIN marks m ON m.symbol = t.symbol AND m.trade_date = t.trade_date
WHERE hour(t.ts) BETWEEN 8 AND 18""",
        "symbol_session_scan": _WITH_TICKS + f"""
SELECT symbol, timestamp, seq, current_price, COALESCE(volume, 0.0) AS volume FROM t
WHERE symbol = '{SCAN_SYMBOL}'
  AND ts BETWEEN TIMESTAMP '{REPORT_DATE} 08:00:00' AND TIMESTAMP '{REPORT_DATE} 18:00:00'""",
        "closing_ticks": _WITH_TICKS + """
SELECT seq, symbol, timestamp, open, current_price FROM t WHERE hour(ts) = 18""",
        "tick_pct_change": _WITH_TICKS + """
SELECT seq, symbol, ROUND((current_price - open) / NULLIF(open, 0) * 100, 2) AS pct_change
FROM t""",
        "bar_pct_change": _WITH_PRICES + f"""
SELECT p.company_id, p.date, {_PCT} AS pct_change FROM prices p""",
        "companies_projection": _WITH_TICKS + "SELECT id, symbol, name FROM companies",
        "seed_ids": """
SELECT row_number() OVER (ORDER BY ts, event_id) AS id, event_id FROM events""",
        "check_not_null": _WITH_TICKS + """
SELECT seq, symbol, name,
       concat_ws(',', CASE WHEN symbol IS NULL THEN 'symbol' END,
                      CASE WHEN timestamp IS NULL THEN 'timestamp' END,
                      CASE WHEN name IS NULL THEN 'name' END) AS null_columns
FROM t WHERE symbol IS NULL OR timestamp IS NULL OR name IS NULL""",
        "check_unique": _WITH_TICKS + """
SELECT symbol, timestamp, count(*) AS n_rows FROM t
WHERE symbol IS NOT NULL AND timestamp IS NOT NULL
GROUP BY symbol, timestamp HAVING count(*) > 1""",
        "check_primary_key": _WITH_TICKS + """
SELECT symbol, trade_date, count(*) AS n_rows,
       CASE WHEN symbol IS NULL OR trade_date IS NULL THEN 'null_key' ELSE 'duplicate' END
         AS violation
FROM t WHERE hour(ts) = 18
GROUP BY symbol, trade_date
HAVING symbol IS NULL OR trade_date IS NULL OR count(*) > 1""",
        "stored_conflicts": _DIRTY.split("timed AS (")[0].rstrip().rstrip(",") + """
SELECT * FROM (SELECT symbol, timestamp, count(*) AS n_new FROM dirty
               WHERE symbol IS NOT NULL AND timestamp IS NOT NULL GROUP BY ALL)
JOIN (SELECT symbol, timestamp, count(*) AS n_stored FROM t GROUP BY ALL) USING (symbol, timestamp)""",
        "check_foreign_key": """
SELECT e.* FROM events e
WHERE e.user_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = e.user_id)""",
        "envelope_roundtrip": _WITH_TICKS + """
SELECT current_price, CAST(user_id AS INTEGER) AS id, name, open,
       ROUND((current_price - open) / NULLIF(open, 0) * 100, 2) AS percent_change,
       symbol, timestamp, volume
FROM t""",
        **LLM_ORACLES,
    }
