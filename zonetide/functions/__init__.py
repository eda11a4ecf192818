"""Column expressions shared by batch, model and streaming code."""
