"""Named analytics: lazy functions from frames to frames."""
