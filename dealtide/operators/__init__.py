"""Generic table operators: duplicates, references, findings, expectations, generated ids."""
