"""pagewright: document audit and document data processing on Spark DataFrames."""
