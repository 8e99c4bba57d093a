"""Putting lines of a quoted CSV back together into records, batch by batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# What a task makes of a split, for each state it may begin in (``variant`` 0: at a record,
# 1: inside quotes).  ``text`` is a whole record.  ``fragment`` is a piece of a record that the split
# shares with a neighbour; a ``head`` began in an earlier split.  The last row of a split has
# neither: its number of ``quotes``, and as bits the variants ``made`` to the end and those ``sent`` at all.
PIECES = (
    "file string, start bigint, variant int, is_header boolean, text string, head boolean, fragment string, "
    "quotes bigint, made int, sent int"
)
_PIECES = pa.schema(
    [
        ("file", pa.string()),
        ("start", pa.int64()),
        ("variant", pa.int32()),
        ("is_header", pa.bool_()),
        ("text", pa.string()),
        ("head", pa.bool_()),
        ("fragment", pa.string()),
        ("quotes", pa.int64()),
        ("made", pa.int32()),
        ("sent", pa.int32()),
    ]
)

# An open record of so many characters makes a variant that may be the wrong one be left alone.
DOUBTFUL = 1 << 20

_QUOTE, _COMMA, _CR = b'",\r'


def _rows(n: int, **columns) -> pa.RecordBatch:
    """A batch of n rows with the given columns; single values are repeated, others are null."""

    def column(field: pa.Field) -> pa.Array:
        value = columns.get(field.name)
        if value is None:
            return pa.nulls(n, field.type)
        if isinstance(value, pa.Array):
            return value
        return pa.repeat(pa.scalar(value, field.type), n)

    return pa.RecordBatch.from_arrays([column(f) for f in _PIECES], schema=_PIECES)


def _out_of_place(lines: pa.Array, odd: bool) -> tuple[bool, bool]:
    """For a start outside and inside quotes: whether a quote stands where no field is quoted or ends.

    ``odd``: whether the number of quotes in the split before these lines is.
    """
    offsets = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset : lines.offset + len(lines) + 1]
    if lines.buffers()[2] is None or offsets[0] == offsets[-1]:
        return False, False
    data = np.frombuffer(lines.buffers()[2], np.uint8)
    at = offsets[0] + np.flatnonzero(data[offsets[0] : offsets[-1]] == _QUOTE)
    if not len(at):
        return False, False
    line = np.searchsorted(offsets, at, side="right") - 1
    before, after = data[np.maximum(at - 1, 0)], data[np.minimum(at + 1, len(data) - 1)]
    opens = (at == offsets[line]) | (before == _COMMA) | (before == _QUOTE)
    closes = (at == offsets[line + 1] - 1) | (after == _COMMA) | (after == _QUOTE) | (after == _CR)
    first = (np.arange(len(at)) + odd) % 2 == 0
    return bool((~np.where(first, opens, closes)).any()), bool((~np.where(first, closes, opens)).any())


class _Variant:
    """The lines of one split so far, for one state at its start, and the open record."""

    def __init__(self, file: str, start: int, inside: bool):
        self.own = {"file": file, "start": start, "variant": int(inside)}
        self.odd = inside
        self.in_head = inside
        self.at_header = start == 0
        self.pending: list[str] = []
        self.held = 0
        self.sent = False

    def take(self, lines: pa.Array, quotes: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Lines, and the number of quotes up to the end of each."""
        odd_after = (quotes + self.odd) % 2 == 1
        starts = np.flatnonzero(~np.concatenate(([self.odd], odd_after[:-1])))
        self.odd = bool(odd_after[-1])
        if not len(starts):
            self._hold(lines)
            return
        self._hold(lines.slice(0, starts[0]))
        yield from self.close(False)
        offsets = pa.array(np.append(starts, len(lines)), pa.int32())
        records = pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")
        if self.odd:
            self.pending = [records[-1].as_py()]
            self.held = len(self.pending[0])
            records = records.slice(0, len(records) - 1)
        yield self._records(records)

    def _hold(self, lines: pa.Array) -> None:
        self.pending += lines.to_pylist()
        self.held += pc.sum(pc.binary_length(lines)).as_py() or 0

    def close(self, at_end: bool = True) -> Iterator[pa.RecordBatch]:
        """Give out the record begun earlier; still open at the end, it is a fragment."""
        if self.pending:
            text = "\n".join(self.pending)
            self.pending, self.held = [], 0
            if self.in_head or (at_end and self.odd):
                self.sent = True
                yield _rows(1, **self.own, head=self.in_head, fragment=text, is_header=self._is_header(1))
            else:
                yield self._records(pa.array([text], pa.string()))
        self.in_head = False

    def _is_header(self, n: int) -> pa.Array:
        flags = np.zeros(n, dtype=bool)
        if n and self.at_header:
            flags[0], self.at_header = True, False
        return pa.array(flags)

    def _records(self, texts: pa.Array) -> pa.RecordBatch:
        self.sent = True
        return _rows(len(texts), **self.own, is_header=self._is_header(len(texts)), text=texts)


class _Split:
    """One split, for all the states it may begin in."""

    def __init__(self, file: str, start: int, states: tuple[bool, ...]):
        self.file, self.start = file, start
        self.variants = [_Variant(file, start, inside) for inside in states]
        self.sent = 0
        self.quotes = 0

    def _leave(self, variant: _Variant) -> None:
        self.variants.remove(variant)
        self.sent |= variant.sent << variant.own["variant"]

    def take(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        if len(self.variants) == 2:
            wrong = _out_of_place(lines, self.quotes % 2 == 1)
            if wrong[0] != wrong[1]:
                self._leave(self.variants[wrong.index(True)])
        quotes = np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False))
        for variant in list(self.variants):
            yield from variant.take(lines, quotes)
            if variant.held > DOUBTFUL and len(self.variants) == 2:
                self._leave(variant)
        self.quotes += int(quotes[-1])

    def close(self) -> Iterator[pa.RecordBatch]:
        made = 0
        for variant in self.variants:
            yield from variant.close()
            made |= 1 << variant.own["variant"]
            self.sent |= variant.sent << variant.own["variant"]
        yield _rows(1, file=self.file, start=self.start, quotes=self.quotes, made=made, sent=self.sent)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Begin and end of the rows of each split."""
    start = batch.column("start").to_numpy(zero_copy_only=False)
    file = batch.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    breaks = np.flatnonzero((np.diff(start) != 0) | (np.diff(file) != 0)) + 1
    edges = [0, *breaks.tolist(), batch.num_rows]
    yield from zip(edges, edges[1:])


def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, line) rows, splits in one piece and in order -> PIECES.

    A split at the start of a file begins at a record.  Any other is put together for both states
    at once.  The states tell themselves apart by the first quotes, nearly always: from
    then on one is followed.  It may be the wrong one, and the caller finds that out.  With a
    column ``inside`` the state is given.
    """
    split = None
    for batch in batches:
        if not batch.num_rows:
            continue
        given = batch.schema.get_field_index("inside") >= 0
        for begin, end in _runs(batch):
            file, start = (batch.column(name)[begin].as_py() for name in ("file", "start"))
            if split is None or (split.file, split.start) != (file, start):
                if split is not None:
                    yield from split.close()
                states = (batch.column("inside")[begin].as_py(),) if given else (False,) if start == 0 else (False, True)
                split = _Split(file, start, states)
            yield from split.take(batch.column("line").slice(begin, end - begin))
    if split is not None:
        yield from split.close()
