import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"word{i % 977} w{i}" for i in range(30_000))
BASE = " ".join(f"near{i}" for i in range(60))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, digest string, run int, n long"


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): nulls, empty and wordless texts, ties, copies, near copies, one long text."""
    return [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "one two three"),
        (5, "One  two\nthree"),
        (6, "one two three four"),
        (7, BASE),
        (8, BASE.replace("near9 ", "other ")),
        (9, BASE.replace("near9 ", "other ").replace("near50", "ALSO")),
        (10, BASE.upper()),
        (11, BASE + " "),
        (12, LONG),
        (13, LONG + " tail"),
        (14, "?!?! 123 --"),
        (15, "mail a.b@c-d.org and x@y.z_q@r.s or 12.34.56.78 255.255.255.256 1.2.3.4.5"),
        (16, "card 4111 1111 1111 1111, 4111111111111112 call +1 (555) 010-2030 or +12"),
        (17, "ΟΔΟΣ ÉCOLE Straße K é " * 4),
        (18, "odd\x0bspace\x0cand\rmore\tof it all here"),
        (19, "7" * 30_000 + " " + "a" * 30_000 + "@"),
    ]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with columns whose names clash with those used inside."""
    rows = [
        (d, t, "en" if d % 2 else None, [None, "b", "a"][d % 3], None, "words", "digest", 7, 9)
        for d, t in texts
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
