"""contactloom: customer-contact analytics expressed as Spark DataFrames."""
