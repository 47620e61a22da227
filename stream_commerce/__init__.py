"""E-commerce event and order analytics as plain Spark DataFrame transforms."""
