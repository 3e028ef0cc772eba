"""Invented texts with planted cases."""

import random

SYLLABLES = "an be co da er fi go ha in ja ke lo mi no or pa qui re sa to un va we xi yo zu".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 3))) for _ in range(n))


def documents(spark, rows):
    """(doc_id, text, lang, source) rows with a column that clashes with results."""
    return spark.createDataFrame([(*r, "clash") for r in rows],
                                 "doc_id long, text string, lang string, source string, n_words string")
