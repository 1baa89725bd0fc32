"""Column functions.  All of them return Spark column expressions; none is a Python UDF."""
