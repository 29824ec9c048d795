"""Plans: the warehouse build, OLAP queries, run summary and the incremental load."""
