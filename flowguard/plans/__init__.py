"""Compositions of operators: experiments, report tables, chart-data tables."""
