"""Operators of a training-data pipeline (op1 to op10) and their queries."""
