"""lakeforge: a medallion sales-analytics library on Spark DataFrames."""

__version__ = "0.1.0"
