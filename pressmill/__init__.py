"""Analytics and classification of large news corpora on Spark."""
