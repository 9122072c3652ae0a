"""tastegraph: neighbourhood-based collaborative filtering on Spark DataFrames."""

__version__ = "0.1.0"
