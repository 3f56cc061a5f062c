"""Row changes with versions, file layout, and data checks."""
