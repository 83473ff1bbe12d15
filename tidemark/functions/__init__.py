"""tidemark: event, cost and reliability analytics on Spark."""
