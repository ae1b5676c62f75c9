"""All queries and their SQL, apart from those of training data."""

from __future__ import annotations

from checks import extension_oracle, extension_queries, oracle, spark_queries

QUERIES = spark_queries.QUERIES | extension_queries.QUERIES
ORACLE = oracle.ORACLE | extension_oracle.ORACLE
