"""Texts that every operator has to take."""

LONG = " ".join(f"word{k % 977} and{k % 31}" for k in range(30_000))
EDGE_ROWS = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "two words"), (6, "three words here"), (7, LONG),
    (8, "x" * 50_000), (None, "a text without an id"), (None, None), (9, "the same row"), (9, "the same row"),
    (9, "another text with that id"), (10, "LINE one\n\nline one\nLine  ONE\n"), (11, "\u00dcber \u65e5\u672c \U0001f600 \u0130\u03a3"),
    (12, "++ -- !! ### $$$ | | |"), (-5, "a negative id"),
]
