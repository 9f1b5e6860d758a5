"""Table jobs and query operators for lakehouse data, written as Spark plans."""
