"""Column libraries: Column in, Column out."""
