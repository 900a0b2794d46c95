"""Operators: DataFrame -> DataFrame building blocks of the market jobs."""
