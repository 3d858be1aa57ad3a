"""Profiling, schema contract, cleaning, modelling and data-quality operators."""
