"""Cleaning and analytics for a star schema of deliveries, matches and players, on Spark DataFrames.

Everything here takes DataFrames and returns DataFrames. Nothing runs until the
caller asks for an action, and no function builds a session of its own.
"""
