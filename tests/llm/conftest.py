from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir() -> str:
    if not Path(SF).exists():
        pytest.skip("test tables are not here")
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with a null in every column, empty, blank and long texts, repeated rows and clashing extra columns."""
    words = "the quick brown fox jumps over a lazy dog while seven wizards quietly brew tea".split()
    line = lambda a, n: " ".join(words[(a * 7 + i * (a + 3)) % len(words)] + str((a * i) % 11) for i in range(n))
    rows = [(i, line(i, 20 + 3 * i), "en" if i % 3 else "fr", f"src{i % 4}") for i in range(24)]
    rows += [(100, line(5, 35), "en", "src1"), (101, line(5, 34) + " end", "en", "src1")]
    rows += [(102, line(2, 400), "fr", "src0"), (103, line(1, 60) + " " + line(9, 47), None, "src2")]
    rows += [(104, None, "en", "src0"), (105, "", "en", "src0"), (106, " \t\n", "fr", None), (107, "12 34 !!", "en", None)]
    rows += [(None, line(4, 32), "en", "src3"), (3, line(3, 29), "fr", "src3"), (3, line(3, 29), "fr", "src3"), (108, "x" * 700, "en", "src1")]
    rows += [(109, "é" * 150 + "ü" + "é" * 150, "fr", "src2")]
    clash = "size long, score double, part int, kind int, ids string, fp long, key long, label int, n long"
    return spark.createDataFrame([(*r, None, None, 1, 2, "x", 3, 4, 5, 6) for r in rows], f"doc_id long, text string, lang string, source string, {clash}")
