"""Market-data operators as Spark DataFrame functions."""
