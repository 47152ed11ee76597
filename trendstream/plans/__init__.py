"""Registered queries with their SQL oracles, the inputs they derive from the tables, and checks."""
