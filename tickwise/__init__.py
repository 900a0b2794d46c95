"""tickwise: market-tick analytics expressed as Spark DataFrame / SQL / Structured
Streaming jobs.

Data flow: snapshot envelopes -> typed ticks -> partitioned tick store -> daily
OHLCV bars (closing-mark rule) -> keyed upsert into ``prices`` -> daily reports.
"""

from tickwise.session import get_session, checkpoint_root

__all__ = ["get_session", "checkpoint_root"]
