"""Loam: curation of web-sourced records on Spark DataFrames."""
