"""foliospark: document, transcript, weather and context analytics on Spark DataFrames."""
