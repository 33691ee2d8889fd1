"""tallyspark: commerce + web-analytics attribution on Spark.

Shop orders are the truth for revenue; web-analytics events supply sessions
and attribution dimensions. Every model is a function from DataFrames to a
DataFrame, built only from the public DataFrame / SQL / Structured Streaming
APIs.
"""

from tallyspark.params import Params

__all__ = ["Params"]
