"""Reading and publishing tables: the path-based store and the raw-table adapter."""
