"""lexmill: a PySpark-native engine for bilingual legal corpora.

Operators are functions from DataFrames to DataFrames; Catalyst plans them.
``lexmill.plans`` holds the named queries, ``lexmill.llm`` the training-data
operators (nothing outside that subpackage imports it).
"""

__version__ = "0.1.0"
