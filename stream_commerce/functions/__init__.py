"""Column-level helpers: times, JSON maps, ages, words."""
