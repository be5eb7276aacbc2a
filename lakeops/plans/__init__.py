"""The registered queries, and the SQL each is compared with."""

from lakeops.plans import models, relational, streams, table_changes

_PARTS = [relational, table_changes, streams, models]

ALL_QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ALL_ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
