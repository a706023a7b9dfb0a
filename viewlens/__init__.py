"""viewlens: viewer-insight analytics on Spark.

Three customer-level tables (content profile, search-keyword change,
recency/frequency/monetary segments) and the reporting marts over them,
each written as DataFrame -> DataFrame functions that Catalyst plans.
"""

__version__ = "0.1.0"
