"""postwise: a Spark-native warehouse for job-posting records.

Messy delimited postings are cleaned with built-in Column expressions,
validated, de-duplicated, loaded step by step into a star schema (six
dimensions and one fact) and queried with DataFrame functions.
"""

__version__ = "0.1.0"
