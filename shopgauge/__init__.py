"""shopgauge: customer analytics for an e-commerce data set, written as PySpark DataFrame operators.

Every operator takes DataFrames (and plain Python parameters such as an as-of date) and returns
a lazy DataFrame. Nothing is collected to the driver; the caller decides the action.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
