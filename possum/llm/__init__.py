"""Operators for training-data pipelines.

Nothing outside this subpackage imports it; ``queries.py`` registers one
query per operator and ``sql.py`` holds the DuckDB SQL where SQL can express
the result.
"""
