"""Distributed operators over DataFrames."""
