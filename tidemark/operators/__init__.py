"""Operators users call: writes, time travel, relational helpers and reports."""
