"""Schema drift and table conformance for a fleet of databases, on Spark DataFrames."""
