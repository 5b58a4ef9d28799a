"""Made-up rows and prose."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(texts, lang="en", source="a"):
    return [(i, t, lang, source, len(t or "")) for i, t in enumerate(texts)]


def prose(rng, n):
    words = [rng.choice("bcdfgklmnprst") + rng.choice("aeiou") + rng.choice(["", "n", "r", "nd", "st"]) for _ in range(n)]
    return " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(words))
