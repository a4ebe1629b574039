"""Registered queries: each module pairs a Spark query with the SQL it must equal."""
