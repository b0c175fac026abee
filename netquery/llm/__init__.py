"""Operators of a training-data pipeline over text, page and vector tables.

Each module holds one operator with its general interface; `queries` registers
the thin `opN_*` queries. Nothing else in the library imports this package."""
