"""Writers for result tables (Spark CSV/JSON writers, folders created on write)."""
