"""sources of quillsift."""
