"""harborlens: exposure analytics over daily banner archives, built on Spark DataFrames."""
