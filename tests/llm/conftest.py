import random

import pytest



def messy_texts() -> list[str | None]:
    """Prose, copies, near copies, a shared passage, blanks, odd white space and a long text."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeiorst", k=rng.randint(1, 9))) for _ in range(800)]

    def prose(n: int) -> str:
        return " ".join(rng.choices(vocabulary, k=n))

    passage = prose(60)
    base = prose(120).split(" ")
    texts: list[str | None] = [prose(rng.randint(1, 150)) for _ in range(20)]
    for _ in range(12):
        near = list(base)
        near[rng.randrange(len(near))] = "changed"
        texts.append(" ".join(near))
    texts += [" ".join(base)] * 3
    texts += [f"{prose(30)} {passage}\n{prose(20)}" for _ in range(4)]
    texts += [None, "", " \t\n", "one", "One", "a b c d", "A  b\tc d", "a b c d e", "x " * 200, "\x85nel nb sp\x1c"]
    texts += [prose(20_000), "é😀 ²." * 50, "w" * 5000, "don't <|endoftext|> we'll 12345  \n\n x"]
    return texts


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with NULL and repeated ids, repeated rows, and columns of clashing names."""
    rows = [(i, text, "en", -1.0) for i, text in enumerate(messy_texts())]
    rows += [rows[0], rows[25], (None, "a b c d e", "en", 0.0), (None, None, None, None), (3, "another text", "en", 1.0)]
    schema = "doc_id long, text string, lang string, score double"
    df = spark.createDataFrame(rows, schema).selectExpr(
        "*", "1L AS key", "2L AS hash", "3 AS predicted", "4L AS n_words", "5L AS n_tokens", "'r' AS row", "6 AS k0",
        "7 AS part", "8L AS n", "9 AS x", "10L AS piece", "11L AS id", "true AS worded", "12 AS row_id",
    )
    return df.repartition(3, "lang").cache()


@pytest.fixture(scope="session")
def messy_rows(messy):
    return [(r["doc_id"], r["text"] or "") for r in messy.select("doc_id", "text").collect()]
