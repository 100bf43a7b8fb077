"""operators of quillsift."""
