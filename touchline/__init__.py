"""touchline: tournament analytics as Spark DataFrame programs.

``sources`` read and write, ``functions`` are Column expressions, ``operators``
map DataFrame to DataFrame, ``plans`` assemble the two marts and the dashboard
panels, ``streaming`` runs the ingest feeds, and ``workload`` holds the
registered queries with their SQL counterparts.
"""
