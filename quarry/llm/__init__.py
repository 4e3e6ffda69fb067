"""Operators for training-data pipelines: ten corpus operators, each a module of its own.

Nothing else in the library imports this package. Every operator takes and returns DataFrames; Python
runs only inside Arrow-batched tasks, and what a task holds is bounded (see each module's docstring).
"""
