"""DataFrame -> DataFrame operators: decode, flatten, upsert."""
