"""DataFrame operators: joins, aggregates, rankings, result tables, models."""
