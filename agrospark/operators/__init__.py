"""Operators: `f(df, ..., **params) -> DataFrame`, lazy, without collects or Python UDFs."""
