"""DataFrame operators: calendar, gate, ranked children, lookups, totals, ordering."""
