"""DataFrame -> DataFrame operators, keyed by ticker and ordered by Date."""
