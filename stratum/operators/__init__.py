"""Operators: each is a plain ``DataFrame -> DataFrame`` function."""
