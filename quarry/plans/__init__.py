"""Composed plans: size-checked broadcasts, dense ordering, the query catalog and its SQL oracle."""
