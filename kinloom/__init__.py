"""A batch engine for matching noisy record sources, on Spark DataFrames."""
