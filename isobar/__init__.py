"""isobar: daily weather analytics as PySpark DataFrame jobs.

Layers: raw observations -> silver (one cleaned table) -> gold (monthly, yearly,
seasonal, alert and comparison tables) -> serving reads, charts, maps, checks.
Every function takes and returns DataFrames; there is no Python UDF.
"""
