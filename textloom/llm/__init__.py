"""Operators of a training-data pipeline.  Nothing else in textloom imports this subpackage."""
