"""A Spark-first engine for curating and scoring text corpora.

Every public function takes and returns DataFrames (or Columns) and builds a
declarative plan; nothing runs until the caller acts on the result.
"""
