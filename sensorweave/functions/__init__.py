"""Column expressions and skew-safe primitives shared by the operators."""
