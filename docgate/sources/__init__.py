"""Readers: everything that turns storage into DataFrames."""
