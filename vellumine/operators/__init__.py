"""DataFrame operators: rules, merges, reports, ranges, layout, validation."""
