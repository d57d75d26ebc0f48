"""Layered refinement of entity tables on Spark: landing, bronze, silver, gold and KPIs."""
