"""Table operators; see the module names for their groups."""
