"""Operators: grid reshaping, geometry, quality-control kernels."""
