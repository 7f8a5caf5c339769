"""Odd rows that every operator must take: nulls, empty and long texts, ties, repeats."""

LONG = "word " * 30_000
UNBROKEN = "x" * 200_000



def morse(doublings: int) -> tuple[str, str]:
    """A Thue-Morse word of 2**doublings letters and its complement: one hash for both in any sum of powers modulo 2**64."""
    a, b = "a", "b"
    for _ in range(doublings):
        a, b = a + b, b + a
    return a, b


KILO, LIKE_KILO = morse(10)
FOUR, LIKE_FOUR = morse(12)
FILL = " ".join(f"f{i}" for i in range(49))

ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two  three"), (6, "é ß 漢字 😀 mixed space"),
    (7, LONG), (8, UNBROKEN), (9, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 4),
    (10, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 4), (11, "tie"), (12, "tie"),
    (13, "don't <|endoftext|> ΣΑΣ é́"), (14, "1" * 3000), (15, "a@b.c." + "d." * 2000),
    (30, KILO), (31, LIKE_KILO), (32, f"{FOUR}\n{LIKE_FOUR}\n{KILO}\n{LIKE_KILO} {FOUR}\n{KILO}"), (33, f"{FILL} {KILO}"), (34, f"{FILL} {LIKE_KILO}"),
    (35, f"{FOUR} {FILL}"), (36, f"{LIKE_FOUR} {FILL} {FILL}"), (37, f"{FOUR} {FILL}"),
]

#: Rows of repeated and null ids, null groups.
REPEATS = [(20, "same text here"), (20, "same text here"), (20, "another text"), (None, "no id"), (None, "no id"), (None, None)]
