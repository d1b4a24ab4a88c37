"""quillspark: corpus building and training-set preparation as Spark jobs."""
