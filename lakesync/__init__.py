"""lakesync: keep lakehouse tables in step with changing record sources, on Spark."""
