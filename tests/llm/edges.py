"""Rows that every operator and stage must take."""

DOCUMENTS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (None, "a row without an id"),
    (None, None, None),
    (5, "Ünïcödé — 日本 語 😀\nline two", None),
    (6, "one"),
    (7, "x" * 30_000),
    (8, "word " * 20_000),
    (9, "same text here for both rows of the same id " * 12),
    (9, "same text here for both rows of the same id " * 12),
    (10, "\n".join(f"line {i % 7} of the long one" for i in range(2000))),
    (11, "0" * 3_000 + "@" + "a." * 3_000 + " " + "1.2." * 3_000 + "a_b@c.d_e@f.g +1+1 (1)2 12345678 +12 345 678 90"),
    (12, "\n".join(" ".join(f"w{i * 13 + j}" for j in range(30)) for i in range(6))),
    (13, "\n".join(["first\r", "", *(" ".join(f"w{i * 13 + j}" for j in range(30)) for i in range(1, 6)), "last"])),
    (14, "One. <|endoftext|> two\x1f three' s <|ENDOFTEXT|>"),
]
ITEMS = [(1, "one"), (2, None), (3, ""), (4, " ".join(["same text here for both rows of the same id"] * 3)), (5, "w39 w40 w41 W42"), (6, "one"), (7, "!!!")]
LABELS = [(1, 1, 0), (None, 1, 0), (9, None, None), (9, 0, 0), (9, 1, 0), (99, 1, 1)]
CONVERSATIONS = [
    (1, 0, "user", "a <turn:x> \\l \\\\ b\n</turn>"),
    (1, 1, "assistant", "\\"),
    (1, 1, "assistant", "\\"),
    (1, None, None, None),
    (2, 0, "assistant", None),
    (2, 1, "sys>tem\n<", "\\n\\g"),
    (None, 0, "user", "no id"),
    (None, 1, "assistant", "é😀<"),
    (3, 5, "assistant", "long " * 20_000),
]
PAGES = [
    (1, None, None),
    (None, "http://a.b.com/en/9", ""),
    (2, "http://a.b.com/en/9", ""),
    (2, "http://a.b.com/en/9", ""),
    (3, "//x", ""),
    (4, "http://1.2.3.4/99999999999999999999", None),
    (5, "https://Www.Example.com/en/1.html?x#y", ""),
    (6, "https://x.net/es/" + "0" * 50_000 + "1", ""),
    (7, "x://\n", ""),
]
