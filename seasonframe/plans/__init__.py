"""Ready-made plans: the statement catalogue, and the checked queries on the driver's tables."""
