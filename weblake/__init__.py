"""Order and weblog analytics on Spark.

Layout: ``sources`` read relational tables, logs and gold tables; ``functions``
holds column expressions; ``operators`` holds DataFrame-level building blocks
(range join, upsert, sampling, serial keys, quality checks); ``plans`` composes
them into the user-facing datasets and reports; ``sinks`` writes tables, text and
JDBC; ``streaming`` runs the incremental landing-to-gold path.
"""

__version__ = "0.1.0"
