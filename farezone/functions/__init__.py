"""Scalar column functions: time keys, labels, money."""
