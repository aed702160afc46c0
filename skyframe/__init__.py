"""skyframe: DataFrame / SQL / Structured Streaming operators.

Modules: ``sources`` (readers, writers, catalog), ``operators`` (relational,
airline, text, logs, clicks, sampling, graph, stats, patterns,
evaluation), ``functions`` (features, similarity, UDFs), ``ml`` (models),
``streaming`` (sources, operators, sinks, learners), ``plans`` (table
adapters, eager-aggregation plans, join helpers, registered queries and
their DuckDB statements).
"""

__version__ = "0.1.0"
