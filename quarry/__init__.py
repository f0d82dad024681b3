"""A Spark-first engine for cleaning, linking and querying large record collections."""
