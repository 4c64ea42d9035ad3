"""The queries of the driver contract: inputs, Spark jobs and the SQL they are checked against."""
