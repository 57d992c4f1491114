"""Column-to-Column building blocks; everything stays inside whole-stage codegen."""
