import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_texts(seed: int = 5, n: int = 60) -> list[str]:
    """Texts with exact copies, edited copies, shared lines, blanks, odd characters and one very long text."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("al", "be", "co", "du", "É") for b in ("na", "ri", "so", "tu", "va", "xe")]
    line = lambda k: " ".join(rng.choice(words) for _ in range(k))
    texts = [f"{line(30)}\n{line(rng.randint(1, 40))}" for _ in range(n)]
    shared = line(14)
    texts += [texts[0], texts[0], texts[1].replace(" ", "  ", 1), texts[2] + " tail", f"{shared}\n{texts[3]}", f"{shared.upper()}\n{line(9)}"]
    base = line(120).split(" ")
    for i in range(12):  # near copies of one text, each with another word changed
        texts.append(" ".join([*base[:i * 4], f"edit{i}", *base[i * 4 + 1:]]))
    texts += ["", " ", "\n\n", "one", "one two three", "ÀÉ ßtraße 日本 🙂 don't STOP", line(5000)]
    return texts


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def frame(spark):
    """(id, text) pairs as documents, with a null text, a repeated row, and columns that clash with internal names."""

    def build(rows, extra: bool = True):
        df = spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], SCHEMA)
        if extra:
            for name in ("word", "line", "node", "score", "length", "rank", "a", "hits", "_words"):
                df = df.withColumn(name, df.source)
        return df

    return build


@pytest.fixture(scope="session")
def rows(texts):
    """Documents by id, with a null text and one row twice."""
    pairs = [(i * 3, t) for i, t in enumerate(texts)]
    return [*pairs, (1000, None), pairs[5], pairs[5]]
