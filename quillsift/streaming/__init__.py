"""streaming of quillsift."""
