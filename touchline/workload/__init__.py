"""Registered queries: every operator run over the benchmark tables.

``frames`` shapes the benchmark tables like the tournament inputs; the query
modules run the library on them and state the same result in plain SQL.
"""
