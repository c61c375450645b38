"""Named queries and end-to-end flows."""
