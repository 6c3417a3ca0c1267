"""Data sources: text, delimited lines, CSV, libsvm, matrix tables."""
