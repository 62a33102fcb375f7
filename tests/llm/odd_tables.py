"""Small tables with every kind of odd row."""

TYPES = "doc_id long, text string, lang string, source string, n_chars long, id string, node long, key string, digest int, count long, tile string, n long, label string, size long, copies string, __x int"


def long_text(seed: int, words: int) -> str:
    return " ".join(f"w{(seed * 7919 + k * k * 31 + k) % 9973}" for k in range(words))


def odd_texts():
    """Texts of all kinds, with copies and near copies."""
    base = long_text(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    line = "This line is long enough to count and it repeats in many texts"
    texts = [
        None, "", " \t\n\r\x0b\x0c ", " 　", "12345 67 ,.!?", "a", "one two three four", "one two three four",
        "One  two\tthree\nfour", base, near, base + " tail", base.upper(), base + " " + base, long_text(2, 30_000), long_text(3, 300),
        "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "it's we'll I'd  \n\n  '' !'s \r\n\t'S ok", "naïve ÉCOLE straße 你好 世界 🙂🙂🏽 \u200d", "a\u00a0 \u2003\u2028\u0085 b\u3000 c", "e\u0301é \x00\x01", "\n\n\n", f"{line}\nfirst", f"x\n  {line.upper()}\t\nlast", f"{line}\r\n{line}",
        f"{line}\nfour", f"five\n{line}", f"{line}", "Released under the MIT License.", "Licensed under CC BY-NC 4.0",
    ]
    return texts


def odd_rows():
    rows = []
    for k, text in enumerate(odd_texts()):
        lang = [None, "en", "fr", "de"][k % 4]
        source = [None, "s1", "s2", "", "ß"][k % 5]
        rows.append((k * 3 - 5, text, lang, source, None, "id", 1, "k", 2, 3, "t", 4, "l", 5, "c", 6))
    return rows
