"""Operators for preparing training data at scale.

Nothing else in the library imports this subpackage. Each module holds one
operator; ``queries`` registers one query per operator.
"""
