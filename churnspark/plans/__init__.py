"""Compositions of operators: preparation, training/evaluation, deployment report."""
