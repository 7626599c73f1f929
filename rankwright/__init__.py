"""Ranking-dataset engine on Spark DataFrames.

Raw e-commerce tables go through a data-quality gate, become leakage-free
session-grouped training rows, train a listwise ranker, and the ranker is
judged by tie-aware NDCG@k.
"""
