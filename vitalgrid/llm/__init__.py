"""Operators for preparing training text at corpus scale.

Each module holds one operator with a general interface and the thin query
that applies it to a whole table.  ``registry`` lists the queries.
"""
