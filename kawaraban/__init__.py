"""Kawaraban: news-corpus jobs on Spark DataFrames.

Pages in, article tables out: HTML selection, link expansion, incremental
upkeep of article tables, token histograms and role extraction, all written as
DataFrame plans.
"""
