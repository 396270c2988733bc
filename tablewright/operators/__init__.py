"""DataFrame operators: projections, dedup, profiles, outliers, correlation, features, models."""
