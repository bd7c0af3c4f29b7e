import random

import pytest

WORDS = {
    "en": "the of and to in that is was for with as his they be at one have this from or had by".split(),
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es".split(),
}


def prose(draw: random.Random, lang: str, n: int) -> str:
    """n words, most of them made up of pieces of the language's common words."""
    pieces = WORDS[lang]
    return " ".join(draw.choice(pieces) if draw.random() < 0.4 else draw.choice(pieces) + draw.choice(pieces) for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """Texts in two languages, copies, near copies, repeated rows, nulls, empty and long ones, clashing columns."""
    draw = random.Random(1)
    rows = []
    for i in range(120):
        lang = ("en", "de")[i % 2]
        text = "\n".join(prose(draw, lang, draw.randint(8, 40)) for _ in range(draw.randint(1, 4)))
        rows.append((i, text, lang, ("s1", "s2", None)[i % 5 % 3]))
    for i in range(120, 150):  # near copies, chains among them
        words = rows[(i - 120) // 3][1].split(" ")
        for _ in range(i % 4):
            words[draw.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), "en", "s1"))
    rows += [(150, None, None, "s1"), (151, "", "en", None), (152, " \n\t ", "de", "s2"), (153, "word", "en", "s1"),
             (154, "WORD", "en", "s1"), (155, "12 34 !!", "en", "s2"), (156, None, "en", "s2"), (None, "no id here", "en", "s1"),
             (157, prose(draw, "de", 20_000), "de", "s1"), (158, "x" * 50_000, "en", "s2"), rows[3], rows[3], (5, "other text", "en", "s1")]
    extra = [(*r, "mine", 1, 2.0, len(r[1] or "")) for r in rows]
    return spark.createDataFrame(
        extra, "doc_id long, text string, lang string, source string, lines string, ids int, score double, n_chars long"
    ).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("doc_id < -1")


@pytest.fixture(scope="session")
def vectors(spark):
    draw = random.Random(2)
    base = [[draw.gauss(0, 1) for _ in range(8)] for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(base)]
    for i in range(60, 110):  # near copies, exact copies, scaled copies
        v = base[i % 7]
        rows.append((i, [x * (2.0 if i % 3 else 1.0) + (draw.gauss(0, 0.12) if i % 4 else 0) for x in v]))
    rows += [(110, None), (111, []), (112, [0.0] * 8), (113, [float("nan")] + [1.0] * 7), (114, [float("inf")] + [1.0] * 7),
             (115, [None] + [1.0] * 7), (116, [1.0, 2.0]), (None, [1.0] * 8), rows[4], rows[4], (120, [1e6] * 8)]
    return spark.createDataFrame([(*r, 0, 9) for r in rows], "vec_id long, embedding array<double>, n int, cell int").repartition(3).cache()
