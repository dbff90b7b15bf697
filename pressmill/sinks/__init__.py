"""Writers for processed articles, splits, profile tables and metrics."""
