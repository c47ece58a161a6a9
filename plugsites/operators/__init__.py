"""DataFrame operators: shape, missing values, checks, areas and consolidation."""
