"""quillsift: submission-integrity analytics as Spark DataFrame plans."""
