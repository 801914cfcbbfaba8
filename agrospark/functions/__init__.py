"""Column expressions and DataFrame-level building blocks shared by the operators."""
