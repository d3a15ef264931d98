"""Operators for preparing training text: one module per operator.

Nothing outside this package imports it. ``queries.py`` holds the registered
queries; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
