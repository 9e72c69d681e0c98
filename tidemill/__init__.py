"""Tidemill: corpus contracts, relational corpus operators and training-data preparation on PySpark."""
