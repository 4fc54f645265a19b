"""Operators for preparing text corpora and entity tables at scale.

Nothing outside this subpackage imports it; ``queries`` and ``sql`` hold what the
driver entry registers when the subpackage is present.
"""
