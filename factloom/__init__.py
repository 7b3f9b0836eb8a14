"""Analytics over collections of fact-check reviews, on Spark DataFrames."""
