"""Named queries over the fragments, and whole workflows."""
