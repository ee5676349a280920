"""Trip-record analytics expressed as Spark DataFrame functions."""
