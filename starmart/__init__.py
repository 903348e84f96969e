"""starmart: star-schema building, profiling and data-quality checks on Spark.

Subpackages: ``functions`` (column expressions), ``operators`` (DataFrame →
DataFrame steps), ``sources`` (readers and sinks), ``plans`` (star builders and
queries), ``streaming`` (incremental appends), ``catalog`` (the registered
queries and their SQL oracles).
"""

__version__ = "0.1.0"
