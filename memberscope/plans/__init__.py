"""Registered queries (``catalog``), their SQL oracle (``oracle``), products
as Spark SQL (``sql``) and batch jobs with a CLI (``jobs``)."""
