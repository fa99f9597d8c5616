"""Analytics for sequence-numbered event tapes on PySpark DataFrames and streams."""
