"""lexiquarry: source-code and text corpora as Spark DataFrames."""
