"""Model composition, the query registry and the SQL oracle."""
