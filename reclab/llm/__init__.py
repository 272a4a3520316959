"""Operators for preparing large text corpora (training-data pipeline).

Nothing outside this subpackage imports it; ``registry`` lists its queries.
"""
