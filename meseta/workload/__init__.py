"""Queries over the test tables that exercise every operator, with SQL oracles."""
