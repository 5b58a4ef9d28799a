import random

import pytest


@pytest.fixture()
def rng():
    return random.Random(7)


@pytest.fixture()
def odd_texts():
    """Null, empty, blank, tiny, repeated and long texts, and some outside ASCII."""
    return [None, "", " \n\t ", "one", "two words", "same text again here", "same text again here", "é ü 東京 \U0001f600 ﬁ", "x" * 70_000, "a b c " * 20_000, "line\nline\n\nline\n", "\n\n", "Ünï\u0301 \x85 \xa0 \u2028z"]
