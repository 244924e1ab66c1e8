"""Named models and the end-to-end build."""
