"""Registered queries on the test tables (``spark_queries.QUERIES``), their DuckDB
twins (``oracle.ORACLE``) and the comparison of both (``check``)."""
