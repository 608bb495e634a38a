"""Trade analytics on Spark: parse, enrich, window, store and serve exchange trades."""
