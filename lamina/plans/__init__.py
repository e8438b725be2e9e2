"""Composed datasets (silver, gold, KPIs) and the medallion job."""
