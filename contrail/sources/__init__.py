"""Reading, landing and writing of tables."""
