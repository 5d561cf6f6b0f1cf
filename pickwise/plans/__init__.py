"""Composed plans: the comparison report, the query catalogue and its SQL oracles."""
