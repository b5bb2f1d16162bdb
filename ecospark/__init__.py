"""ecospark: species-trait and occurrence-table compilation as Spark DataFrame operators.

Layout
------
functions/  column expressions (lenient parsing, first-match string ops, recode, rule tables, NA predicates)
operators/  DataFrame -> DataFrame operators (columns, filters, null-safe joins, fills, reshape, aggregates)
sources/    delimited readers with R-style missing-value handling, header promotion, sinks
plans/      composite recipes (trait compilation, occurrence assembly, summaries) and the registered queries
streaming/  incremental (micro-batch) ingestion of landed count files into the long occurrence table
"""

from ecospark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
