"""Financial reconciliation, replay and training-data preparation on Spark DataFrames."""
