"""Compositions of operators: cleaning, reports, the staged job, named queries."""
