import random

import pytest


@pytest.fixture(scope="session")
def corpus():
    """Small texts with copies, near copies, shared passages, empty, null and odd ones."""
    rng = random.Random(7)
    vocabulary = ["the", "of", "and", "in", "Straße", "été", "niño", "token", "data", "spark", "x1", "Window", "a"]
    vocabulary += ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    passage = prose(60)
    texts = [prose(rng.randint(1, 150)) for _ in range(50)]
    for text in texts[:8]:
        texts.append(text)
        words = text.split(" ")
        for _ in range(max(1, len(words) // 60)):
            words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [prose(20) + " " + passage + "\n" + prose(20) for _ in range(4)]
    long = prose(9000)
    texts += ["", "   \n\t ", None, "a", "word", "WORD", "one two three four", "One two\tthree four", long, long + " end"]
    texts += ["be be be " * 80, "12345 !!! ###", "x" * 450, "é" * 230, "a　b\x1cc ​"]
    return list(enumerate(texts, 10))


@pytest.fixture
def frame(spark):
    """Documents from (id, text) pairs, with columns whose names an operator might use itself."""

    def make(rows, **more):
        extra = {"lang": "en", "words": "w", "n": 1, "cls": 2, "row": 3, "spans": "s", "label": None, **more}
        schema = "doc_id long, text string, lang string, words string, n int, cls int, row int, spans string, label string"
        return spark.createDataFrame([(*row, *extra.values()) for row in rows], schema)

    return make
