"""Operators from DataFrame to DataFrame, lazy and without Python on the executors."""
