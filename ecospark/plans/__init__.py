"""Composite recipes and the registered queries.

attributes.py, occurrences.py, summaries.py  the original deliverables (C1-C24) as functions of landed sources
trait_rules.py                           the fixed rule tables of the trait compilation
jobs.py                                  end-to-end jobs over raw files (what the original scripts do when run)
testdata.py, testdata_attributes.py          raw-shaped sources derived from the driver test data (+ the same in SQL)
queries_*.py, catalog.py                 registered queries over whole test-data tables, each with a DuckDB oracle
"""
