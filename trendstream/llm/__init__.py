"""Operators of a training-data pipeline (de-duplication, quality, packing, ...).

One module per operator; ``queries`` registers them for the driver.  Nothing
outside this folder imports it.
"""
