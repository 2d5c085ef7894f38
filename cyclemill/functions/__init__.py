"""Column expressions and numeric kernels."""
