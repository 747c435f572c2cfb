"""Reading and writing: explicit schemas, nothing inferred."""
