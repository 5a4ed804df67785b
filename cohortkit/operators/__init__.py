"""Operators: DataFrame in, DataFrame (or a few fitted numbers) out."""
