"""spanmill: Spark-native operators that turn passages, questions and answer spans
into retrieval-QA training tables.

Every operator takes and returns DataFrames; nothing is collected to the driver
except tiny option or per-partition bookkeeping tables.
"""

__version__ = "0.1.0"
