"""stratum — Spark-native operators for entity-sequence and tabular modelling.

Every operator is a plain ``DataFrame -> DataFrame`` function built from the
DataFrame / SQL API so that Catalyst and adaptive execution plan the work.
"""

__version__ = "0.1.0"
