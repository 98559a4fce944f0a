"""Column functions: ``text`` (strings, regexes, arrays, casts, JSON,
vectors) and ``chat`` (chat templates)."""
