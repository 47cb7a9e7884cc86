def bag(rows):
    """Rows as a sorted list, with their repeats."""
    return sorted(map(repr, rows))
