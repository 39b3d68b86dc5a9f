"""Operators for large-scale text corpora (training-data preparation).

Each module holds one operator with its own general interface; ``queries``
applies the operators to the given tables, ``oracle`` states what plain SQL
can state.  Nothing else in the library imports this subpackage.
"""
