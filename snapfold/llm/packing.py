"""Cost-balanced packing of documents into sequences.

Documents become token ids with an end id.  Blocks of about `block_tokens` tokens are
packed on their own: the sequences of a block hold its tokens exactly, full ones of
`length` tokens and, for the rest, one for each power of two in it, so nothing is padded.
Documents are taken in descending length; each goes to the sequence of lowest cost that
has room, where a piece of n tokens costs `linear * n + quadratic * n * n`
(attention within the piece).  What doesn't fit is cut off and goes on the same way, so
a long document fills empty sequences first.

Blocks follow the table's own order inside a scan task: no text is shuffled, and memory is
bounded by a block plus one document.  The input must be a table or another plan whose
partitions come out alike when they are computed again, as a written table does.

Null and empty texts are one end id.  Repeated rows are packed each.  Equal lengths are
taken by doc_id, null last, then by order.  An empty table gives no pieces.
Other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from snapfold.llm.encoding import encode_documents
from snapfold.llm.words import chunks

LENGTH = 2048
BLOCK_TOKENS = 1 << 21
LINEAR, QUADRATIC = 1.0, 1.0 / 1024

PIECES = (
    "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, sequence_length bigint, cost double"
)


def capacities(tokens: int, length: int = LENGTH) -> list[int]:
    """Sizes of the sequences for so many tokens: full ones, then the powers of two of the rest."""
    rest = tokens % length
    return [length] * (tokens // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(sizes: list[int], length: int = LENGTH, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """(document, start, n, sequence, offset) of every piece; documents must come in the order to take.

    Returns the pieces, and the capacity and the cost of each sequence.
    """
    room = capacities(sum(sizes), length)
    total, cost = list(room), [0.0] * len(room)
    queue = [(0.0, -r, s) for s, r in enumerate(room)]
    heapq.heapify(queue)
    pieces = []
    for doc, left in enumerate(sizes):
        size = left
        while left:
            _, _, s = heapq.heappop(queue)
            n = min(left, room[s])
            pieces.append((doc, size - left, n, s, total[s] - room[s]))
            room[s] -= n
            left -= n
            cost[s] += linear * n + quadratic * n * n
            if room[s]:
                heapq.heappush(queue, (cost[s], -room[s], s))
    return pieces, total, cost


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH, block_tokens: int = BLOCK_TOKENS,
         linear: float = LINEAR, quadratic: float = QUADRATIC) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    sequence_length, cost (of the whole sequence)."""
    if length & (length - 1):
        raise ValueError("the sequence length must be a power of two")
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = docs.schema["doc_id"].dataType
    arrow_id = to_arrow_type(id_type)
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length"]

    def packed(block: list, first_sequence: int) -> tuple[pa.RecordBatch, int]:
        block = sorted(block, key=lambda d: (-len(d[1]), d[0] is None, d[0] or 0))
        pieces, total, cost = assign([len(ids) for _, ids in block], length, linear, quadratic)
        doc, start, n, sequence, offset = (np.array(x, dtype=np.int64) for x in zip(*pieces, strict=True))
        crc = [
            zlib.crc32(block[d][1][s : s + k].astype("<u4", copy=False).tobytes()) for d, s, k, _, _ in pieces
        ]
        sizes = np.array([len(ids) for _, ids in block])
        columns = [
            pa.array([block[d][0] for d in doc.tolist()], arrow_id),
            *(pa.array(x, pa.int64()) for x in (
                start, n, np.array(crc, dtype=np.int64), sizes[doc], first_sequence + sequence, offset,
                np.array(total)[sequence])),
            pa.array(np.array(cost)[sequence], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", *names, "cost"]), len(total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, tokens, sequence = [], 0, TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in chunks(batch):
                found = encode_documents(part.column("text"), tokenizer, end_id)
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), found, strict=True):
                    # Copied, so that a block doesn't hold on to whole chunks.
                    block.append((doc_id, ids.copy()))
                    tokens += len(ids)
                    if tokens >= block_tokens:
                        out, used = packed(block, sequence)
                        block, tokens, sequence = [], 0, sequence + used
                        yield out
        if block:
            yield packed(block, sequence)[0]

    return docs.select("doc_id", "text").mapInArrow(run, PIECES.format(id=id_type.simpleString()))
