"""Contract-driven layered tables (raw, conformed, analytical) and reports on Spark."""
