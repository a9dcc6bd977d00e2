"""Composed pipelines: weather, crimes and station domains (``weather``,
``crimes``, ``medallion``) and the registered queries over the bundled test
tables (``bundled``, ``bundled_io``, ``bundled_domain``) with their oracle
SQL (``bundled_sql``)."""
