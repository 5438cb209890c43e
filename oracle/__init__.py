"""Independent DuckDB SQL for every registered query (the correctness
oracle).  Written from the query semantics, not generated from the Spark
plans."""
