"""Small helpers for operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut batches so that only few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column as strings; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def words_of(text: str) -> list[bytes]:
    """Runs of characters other than space, tab, LF, VT, FF and CR, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def bounded(batches: Iterator[pa.RecordBatch], column: str, rows: int = 256, size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches to few rows and few bytes of a text column; a longer text is a batch by itself."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for at, length in enumerate(lengths):
            if at > start and (at - start == rows or held + length > size):
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += length
        if batch.num_rows > start:
            yield batch.slice(start)


def stretches(text: str, size: int = 1_000_000) -> Iterator[str]:
    """A text in parts of about `size` characters that end before a space (longer ones where no space comes)."""
    start = 0
    while len(text) - start > size:
        end = text.find(" ", start + size)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:] if start else text
