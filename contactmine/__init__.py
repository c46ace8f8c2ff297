"""Mine contact records out of tables of crawled web pages, on Spark.

Layers, bottom up: ``functions`` (Column expressions), ``sources`` (page
tables, the HTML tree), ``operators`` (DataFrame transformations), ``plans``
(a whole source from its profile), ``sinks`` and ``streaming``.
"""
