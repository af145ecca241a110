from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """Words that look random but are the same each time."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x // 65536 % len(WORDS)] + str(x // 4096 % 89))
    return " ".join(out)


def documents(spark: SparkSession, rows: list[tuple], extra: bool = True) -> DataFrame:
    """``(doc_id, text)`` rows as documents; with ``extra`` also columns named like internal ones."""
    full = [(i, t, "en" if k % 2 else None, f"src{k % 3}" if k % 5 else None, len(t or ""))
            for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(full, DOCUMENTS)
    if extra:
        for name in ("score", "lang_pred", "copies", "digest", "tag", "leaf", "epochs", "cut", "domain", "component", "_digest"):
            df = df.selectExpr("*", f"'{name}' as `{name}`")
    return df


#: Nulls, empty and white texts, a long one, repeats of a row, an id with two texts, copies, near copies.
def awkward() -> list[tuple]:
    base, long = prose(1, 60), prose(2, 30_000)
    near = base.split()
    near[30] = "changed"
    return [(0, base), (1, None), (2, ""), (3, " \n\t "), (4, base), (4, base), (5, " ".join(near)), (5, prose(3, 40)),
            (None, base), (None, prose(4, 20)), (6, long), (7, "one two"), (8, "One  two"), (9, "été à la plage, où ?"),
            (10, long + " end"), (11, prose(5, 200)), (12, "1234 !!")]


@pytest.fixture(scope="session")
def odd(spark) -> DataFrame:
    return documents(spark, awkward()).cache()


@pytest.fixture(scope="session")
def nothing(spark) -> DataFrame:
    return documents(spark, [])
