"""End-to-end compositions, the adapters over the test tables and the query catalogue."""
