"""Arrow batches cut by rows and by bytes, so that a batch of very long texts isn't held whole in Python."""

from __future__ import annotations

from collections.abc import Iterator

#: Rows and bytes of text worked on at once; a longer text stands alone.
ROWS, BYTES = 2_000, 4 << 20


def slices(batch, column: int, rows: int = ROWS, size: int = BYTES) -> Iterator:
    """The batch in consecutive parts."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if i > start and (i - start >= rows or held + n > size):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield batch.slice(start)
