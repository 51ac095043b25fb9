"""tidewell: train regression models on tables and score streams with them, on Spark.

Every operator takes and returns DataFrames. The relational work (casts, per-key
reduction, history lookup, merge, upsert, latest-by-key) is declared with the
DataFrame API so Catalyst and AQE choose the physical plan; the model work uses
Spark ML estimators.
"""

__version__ = "0.1.0"
