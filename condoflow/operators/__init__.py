"""Table operators: joins, aggregations and windows shared by the jobs."""
