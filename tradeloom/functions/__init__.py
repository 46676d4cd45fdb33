"""Scalar functions as plain Column expressions."""
