"""Whole jobs from input files to output files."""
