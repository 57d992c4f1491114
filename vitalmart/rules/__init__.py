"""Ready-made rule packs: values only, the operators take them as parameters."""
