"""DataFrame operators: parsing, latest-version selection, time series,
analytics and data-quality measures."""
