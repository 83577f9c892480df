"""Documents with nulls, empty and long texts, ties and repeated rows."""

EDGE = [
    (5, None, None), (6, "", "b"), (None, "a b", "b"), (None, None, None), (7, "a b", "a"), (8, "a b", "a"),
    (8, "a b", "a"), (9, "word " * 3000, "c"), (10, " \t\n ", "c"), (11, "a  b", "a"), (12, "ü€😀 <|endoftext|> x", "d"),
]
