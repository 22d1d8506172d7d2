"""The surveillance warehouse: staging, star schema, analytics, quality, query API."""
