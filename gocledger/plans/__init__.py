"""Plans: the model DAG (pipeline), the query registry and the SQL oracle."""
