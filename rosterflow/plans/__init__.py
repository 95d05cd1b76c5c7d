"""Composed deliverables and the operator queries bound to the test tables."""
