"""Operators for preparing training text: one module per operator.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries and their SQL; ``corpus_pipeline.py`` at the repository top
chains five of the operators.
"""
