"""Tidewater: lazy DataFrame operators for reports, statistics, warehouse loads and alerts on Spark."""
