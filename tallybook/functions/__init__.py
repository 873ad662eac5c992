"""SQL expressions: each function takes and returns expression text.

A column name is the simplest expression; results go into ``selectExpr`` or
``F.expr``.
"""
