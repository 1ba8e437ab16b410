"""Scalar column builders and small frame projections."""
