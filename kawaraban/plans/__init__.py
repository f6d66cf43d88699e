"""Whole jobs: page tables in, article tables out."""
