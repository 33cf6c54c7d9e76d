"""DataFrame operators, grouped by the task they serve."""
