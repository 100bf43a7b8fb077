"""functions of quillsift."""
