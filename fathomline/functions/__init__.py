"""Column functions: frames, geodesy, times, text."""
