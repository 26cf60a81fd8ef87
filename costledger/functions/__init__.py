"""Column functions: text, numbers and cost measures. All native expressions."""
