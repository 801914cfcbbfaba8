"""End-to-end jobs made of operators; each returns DataFrames or writes dated tables."""
