"""Composite jobs: the daily report (RPT-6) and the nightly chain (BAR-2 then RPT-6)."""
