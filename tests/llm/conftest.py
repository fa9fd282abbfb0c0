import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SHARED = "This very line is shared by a good many of the documents."
STORY = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
# Names that the operators use for columns of their own.
CLASHING = ["row", "kept", "node", "id", "ids", "hits", "shard", "slot", "key", "host_key", "base_failed", "component_id"]


def odd_documents():
    """Nulls, empty and long texts, ties and repeated rows."""
    long_text = "\n".join(f"line {i} of a very long text that goes on and on about number {i % 97}" for i in range(4000))
    return [
        (1, STORY + "\n" + SHARED),
        (2, STORY + "\n  " + SHARED.upper() + "\t\n" + SHARED),
        (3, None),
        (4, ""),
        (5, long_text),
        (6, long_text + "\nand one more"),
        (7, " \t\n\x0b\x0c\r \n"),
        (8, "word"),
        (9, "word"),
        (9, "word"),
        (None, SHARED),
        (None, STORY + "\n" + SHARED),
        (10, "x" * 30000),
        (11, SHARED + "\n" + SHARED + "\nÉté ÀÇ 漢字 \x1c\x85　 'tis we'll #*$%&|<>"),
        (12, STORY + " seventeen\n" + SHARED + "\r\n\r\n"),
        (12, STORY + " seventeen\n" + SHARED + "\r\n\r\n"),
        (-5, "negative ids are ids too, " * 8),
        (2**62, STORY + " " + STORY),
    ]


@pytest.fixture(scope="session")
def odd_rows():
    return odd_documents()


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text) rows, with sources, nulls and clashing columns."""

    def build(rows):
        full = [
            (doc_id, text, "en", None if i % 5 == 0 else f"src{i % 3}", None, *[f"{c}{i}" for c in CLASHING])
            for i, (doc_id, text) in enumerate(rows)
        ]
        extra = "".join(f", {c} string" for c in CLASHING)
        frame = spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long{extra}")
        return frame.repartition(3) if full else frame

    return build


def in_order(rows):
    """Rows with nulls, sorted."""
    return sorted(rows, key=lambda row: tuple((v is not None, v) for v in row))
