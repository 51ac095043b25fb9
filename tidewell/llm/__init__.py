"""Training-data operators: deduplication, search, scoring, mixing, archives.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
only when the package is present. Operators take DataFrames and return
DataFrames; ``queries.py`` binds them to the driver's tables.
"""
