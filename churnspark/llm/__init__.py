"""Operators for preparing training text at scale.

One module per operator, each with a general DataFrame-in, DataFrame-out
interface; ``queries`` holds the thin registered queries over ``documents``.
Nothing else in the library imports this subpackage.
"""
