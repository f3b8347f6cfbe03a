"""Commerce lakehouse on Spark: landed CSV files to trusted tables, a star schema and marts."""
