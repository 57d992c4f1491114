"""Named jobs and reports composed from the operators."""
