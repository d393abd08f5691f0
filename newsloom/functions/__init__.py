"""Column-level functions (built-in expressions first, Arrow UDFs for residuals)."""
