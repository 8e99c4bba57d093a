"""Whole jobs made of the operators, and the queries registered on the test tables."""
