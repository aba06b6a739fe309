"""Typed sources (CSV / Parquet), the test-fixture adapter and table sinks."""
