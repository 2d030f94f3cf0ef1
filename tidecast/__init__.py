"""tidecast — panel demand forecasting and inventory decisions on Spark.

Every operator is a pure ``DataFrame -> DataFrame`` function over a panel of
many stores; time-series features use windows partitioned by store, so one
plan serves every store at once.
"""

__version__ = "0.1.0"
