"""txgraph: transaction-stream and transaction-graph analytics on Spark DataFrames."""
