"""Operators for preparing training text: one module per operator.

``queries`` registers one query per operator, ``ORACLE`` holds the SQL of those
that SQL can express.  Nothing outside this subpackage imports it.
"""
