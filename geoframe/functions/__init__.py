"""Column functions: times in names and paths, epochs, sentinels, gains, narrow types, keys and attributes."""
