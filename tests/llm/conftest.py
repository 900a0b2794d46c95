import os

import pytest

from tests.conftest import SF001

LONG = ("lorem ipsum dolor sit amet consectetur " * 3000).strip()
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"

# (doc_id, text): nulls, empties, a very long text, ties, copies, near copies,
# repeated rows and repeated ids.
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today\nSecond line here"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today\nSecond line here"),
    (3, "the QUICK brown fox jumps over the lazy dog near the river bank today!\nAnother line"),
    (4, None), (5, ""), (6, " \t\n"), (None, "no id at all"), (None, None),
    (7, LONG), (8, LONG), (9, f"before {PASSAGE} after"), (10, f"{PASSAGE.upper()}, and more words"),
    (11, "Ünïcödé Straße ΑΣ İx <|endoftext|> 日本語 don't \x1c x\x85y"),
    (11, "Ünïcödé Straße ΑΣ İx <|endoftext|> 日本語 don't \x1c x\x85y"),
    (11, "the same id, another text"), (12, "one"), (13, "one"), (14, "one two"),
    (15, "x\n\nx\nx\n \nShort line\nThis line is long enough to have a near copy of itself, is it not?"),
    (16, "This line is long enough to have a near copy of itself, is it not!\ny"),
]
ITEMS = [(1, PASSAGE), (2, "one two"), (2, "one two"), (3, None), (None, "lazy dog near"), (4, "!?"), (5, "")]


def docs_frame(spark, rows=DOCS):
    """Documents with null columns and extra ones whose names clash with the operators' own."""
    clash = ("row_key", "fingerprint", "component_id", "n_words", "hits", "counts", "score", "ids", "line",
             "dropped_lines", "kept", "q_words", "host", "digest", "label")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{c} string" for c in clash)
    return spark.createDataFrame([(d, t, None, "s", None, *[c for c in clash]) for d, t in rows], schema)


def write(spark, folder, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    """Documents, benchmark and labels with every odd case."""
    folder = str(tmp_path_factory.mktemp("edge"))
    labels = [(1, 1, 0), (2, 1, 0), (3, None, None), (None, 1, 1), (9, 0, 1), (9, 0, 0), (12, 1, 1), (99, 1, 1)]
    return write(
        spark, folder, documents=docs_frame(spark),
        benchmark=spark.createDataFrame(ITEMS, "item_id long, text string"),
        labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    """All tables without rows."""
    folder = str(tmp_path_factory.mktemp("empty"))
    tables = {t: spark.read.parquet(f"{SF001}/{t}.parquet").limit(0)
              for t in ("documents", "benchmark", "labels", "pages", "conversations")}
    return write(spark, folder, **tables)
