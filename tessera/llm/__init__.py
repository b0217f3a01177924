"""Training-data operators and the queries that apply them.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when the subpackage is present.
"""
