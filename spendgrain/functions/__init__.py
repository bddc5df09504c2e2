"""Column expressions shared by the operators; all are built from Spark's own functions."""
