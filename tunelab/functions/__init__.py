"""Column builders: everything here returns a native Spark ``Column``."""
