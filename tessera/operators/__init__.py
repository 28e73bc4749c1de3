"""Operators: DataFrame -> DataFrame building blocks used by the plans."""
