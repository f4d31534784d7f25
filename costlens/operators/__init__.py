"""DataFrame -> DataFrame operators: scope, interval joins, rollups."""
