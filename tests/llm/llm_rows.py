"""Rows that every operator must take."""

#: Null id, null and empty texts, repeated rows, ties, one word over and over, signs, a long text.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a"), (4, "a"), (None, "x y z " * 30), (5, "x y z " * 30), (6, "é😀 ß́ " * 40),
    (7, "same line\n" * 60), (7, "same line\n" * 60), (8, "w" * 3000), (9, "word " * 4000), (10, "Ein Satz. " * 3), (-3, "minus one"),
    (11, " ".join(f"t{i % 97}" for i in range(600))), (12, "A" * 99), (13, "b" * 100), (14, "b" * 101),
]
