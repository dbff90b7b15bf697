"""Ready-made plans over the provided tables, each with an independent SQL twin."""
