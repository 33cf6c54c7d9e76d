"""Compositions of the operators: curation, analysis, model search and bias check."""
