"""quire: curate, clean, split and pack large text collections with Spark DataFrames."""

__version__ = "0.1.0"
