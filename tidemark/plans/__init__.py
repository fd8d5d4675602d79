"""Composite jobs: ingest (lines -> run table), end-of-day correction,
quote analytics; plus the mapping of the driver's ``events`` table onto
market data used by the registered queries and the tests."""
