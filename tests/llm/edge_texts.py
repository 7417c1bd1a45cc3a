"""Texts that every operator has to stand: nulls, empty and very long ones, ties and repeated rows."""

EDGE = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (5, "a b c d e f g"),
    (5, "a b c d e f g"),
    (6, "a b c d e f g"),
    (None, "a b c d e f g"),
    (7, "wörd " * 30_000),
    (8, "x" * 50_000),
    (9, "日本語 \U0001f389 <|endoftext|> Ā́"),
]
