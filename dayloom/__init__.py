"""dayloom: daily batch data pipelines written as plain Spark DataFrame jobs."""
