"""Scalar and batch functions shared by the operators."""
