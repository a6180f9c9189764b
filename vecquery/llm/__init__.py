"""Operators for preparing training data: one module per operator, one query per operator in ``registry``."""
