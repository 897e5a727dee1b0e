"""Rows that every operator must take."""

#: null, empty, blank, short, repeated, tied and very long texts; ids null and repeated
ODD_ROWS = [
    (3, None, "en", "a"),
    (1, "", None, None),
    (2, " \t\n ", "de", "a"),
    (5, "one two three.", "en", None),
    (4, "Ünïcode wörds of späce. " * 12, "de", "b"),
    (7, "Ünïcode wörds of späce. " * 12, "de", "b"),
    (7, "Ünïcode wörds of späce. " * 12, "de", "b"),
    (7, "the same id with another text, long enough to be kept by every rule there is.", "en", "b"),
    (None, "A text without an id, with more than ten words in it, which stands once.", "en", "c"),
    (None, None, None, None),
    (9, " ".join(f"word{i * i % 9973}" for i in range(30_000)) + ".", "en", "c"),
    (8, "x" * 70_000, "fr", "c"),
    (-4, "no.\n" * 40 + "\U0001f600 end of it all with a few words more to make it ten.", "es", "c"),
]

SCHEMA = "doc_id long, text string, lang string, source string"
#: names that the operators use inside
CLASHES = ("block", "share", "kept", "score", "node", "part", "ids", "threshold", "turn", "at", "n_chars", "size", "label")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
