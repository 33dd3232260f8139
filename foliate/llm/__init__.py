"""Operators for preparing large training corpora.

Nothing outside this subpackage imports it. Each module holds one operator; `registry`
maps query names to functions and, where SQL can say the same, to DuckDB SQL.
"""
