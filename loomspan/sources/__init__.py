"""Readers and writers of the pipeline's formats. All are line-parallel or file-parallel Spark reads."""
