"""Ready-made cleaners, marts and runs for the food-security data model."""
