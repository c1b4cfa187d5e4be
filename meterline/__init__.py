"""meterline: monthly trip files to a checked star schema and a fare model, on Spark DataFrames."""

__version__ = "0.1.0"
