"""Training-data operators over the ``documents`` and ``conversations`` tables.

Nothing outside this subpackage imports it; ``registry`` holds its queries and SQL.
"""
