import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    out = []
    for _ in range(n):
        seed = (seed * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(WORDS[(seed >> 33) % len(WORDS)] + str((seed >> 50) % 7))
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows with everything that may be odd: NULLs, empty and long texts, repeated rows, clashing names."""
    base = prose(1, 120)
    words = base.split()
    rows = [
        (0, base),
        (1, base.upper()),  # equal after folding
        (2, " ".join([*words[:60], "changed", *words[61:]])),  # near copy
        (3, prose(2, 80)),
        (3, prose(2, 80)),  # a repeated row
        (3, prose(3, 90)),  # the same id, another text
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "two words"),
        (8, "Two  WORDS"),
        (None, prose(4, 70)),
        (None, None),
        (9, prose(5, 30000)),
        (10, "é ñ ß 日本語 👩‍👧     é " * 30),
        (11, "same line\n" * 40 + "# # $ % | < >"),
        (12, prose(4, 70)),
    ]
    rows = [(i, t, 1, "a", "b", 2, "c") for i, t in rows]
    names = "doc_id long, text string, n_tokens int, kept string, base string, component_id int, key string"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
