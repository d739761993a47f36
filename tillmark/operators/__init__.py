"""DataFrame operators: joins, reports, hierarchy, constraints, guards and table changes."""
