"""The operators bound to the driver's tables: one named query each, with its SQL check.

Each module has ``QUERIES`` (name -> function of session and folder) and ``ORACLE``
(name -> the same result as SQL). Inputs the given tables lack, such as JSON
documents or detail pages, are derived by Spark from every row of a given table.
"""

from shelfspark.bindings import dedup_bindings, json_bindings, listing_bindings, page_bindings, text_bindings

_MODULES = (json_bindings, text_bindings, dedup_bindings, page_bindings, listing_bindings)


def all_queries() -> dict:
    return {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
