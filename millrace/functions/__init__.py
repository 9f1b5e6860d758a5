"""Column functions: each takes Columns and gives a Column, so all stay in generated code."""
