"""Versioned (bitemporal) tables on Spark DataFrames.

A table is an append-only write log.  Every write carries the valid-time period
it speaks about and the transaction that made it; reading a table means
resolving that log as of a valid time and a system time.
"""
