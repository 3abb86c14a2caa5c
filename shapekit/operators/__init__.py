"""DataFrame -> DataFrame operators built from Spark relational primitives."""
