"""plans of quillsift."""
