import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, _row string"


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 9)) * (r.random() < 0.2) for _ in range(n))


@pytest.fixture(scope="session")
def texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, ties, repeated rows, near copies, shared passages, and separators of all kinds."""
    base, passage = prose(1, 120), prose(2, 70)
    near = base.split(" ")
    near[60] = "CHANGED"
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, base.upper()), (5, None), (6, ""), (7, "  \t\n\r "), (8, "one two"), (9, "One TWO"), (9, "One TWO")]
    rows += [(10, "a b c d e"), (11, "a b c d e f"), (12, "a b c"), (13, prose(3, 40) + "\n" + passage + "\n" + prose(4, 30)), (14, passage + " " + prose(5, 50)), (None, prose(6, 30)), (None, passage)]
    rows += [(15, prose(7, 9000)), (16, "x" * 30_000), (17, "▁ ▁▁ \U0001f642 日本語 é\u0000z"), (18, "ab" * 700), (19, "line one is here now\n" * 6)]
    rows += [(100 + i, " ".join([f"edit{i}" if j == 3 * i + 5 else w for j, w in enumerate(base.split(" "))])) for i in range(12)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0, "r") for i, t in texts], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
