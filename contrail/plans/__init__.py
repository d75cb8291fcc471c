"""Whole runs: the daily refresh and the registered queries with their SQL twins."""
