"""Column functions: text, similarity, geometry and reproducible fractions."""
