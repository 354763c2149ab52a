"""Six kinds of analytics (relational, JSON, time series, spatial, graph, vector) as PySpark DataFrame operators."""
