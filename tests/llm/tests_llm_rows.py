"""Rows that operators must take."""

LONG = "lorem ipsum dolor sit amet " * 8000
ODD_ROWS = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, LONG, "en", "a"),
    (4, "one two three", "en", "b"),
    (4, "one two three", "en", "b"),
    (None, "a row without an id", None, "b"),
    (5, " \t\n\x0b ", "fr", None),
    (6, "12345 !!", "fr", None),
]
