"""Electricity-market analytics on Spark: raw landings to bronze, silver and gold tables.

Every transformation is a function from DataFrames to a DataFrame; nothing runs until a
sink, an audit count or the caller asks for rows.
"""
