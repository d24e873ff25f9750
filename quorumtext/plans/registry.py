"""All named queries of the archive operators and the SQL they must equal."""

from __future__ import annotations

from quorumtext.plans import archive_queries, depth_queries, text_queries, turn_queries

QUERIES = {**turn_queries.QUERIES, **text_queries.QUERIES, **archive_queries.QUERIES, **depth_queries.QUERIES}
ORACLE_SQL = {**turn_queries.ORACLE_SQL, **text_queries.ORACLE_SQL, **archive_queries.ORACLE_SQL, **depth_queries.ORACLE_SQL}
