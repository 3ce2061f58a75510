"""Evaluation operators for grouped binary classifiers, built on Spark DataFrames."""
