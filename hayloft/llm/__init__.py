"""Training-data operators: mixing, de-duplication, scoring, formatting, scans.

Every module holds one operator; ``queries`` binds them to the given tables
and ``oracle`` holds the DuckDB SQL of those SQL can express.
"""
