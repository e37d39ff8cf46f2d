"""Inputs, queries and reference SQL for checking the package on the test tables."""
