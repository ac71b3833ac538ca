"""Column -> Column building blocks.  Everything here is a composition of
built-in Spark SQL expressions so it stays inside whole-stage codegen."""
