"""Concatenate and cut: all token ids as one stream, cut into sequences of equal length."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.encoding import END_ID, part_bases, staged_ids, widened

LENGTH = 4096


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of the documents in sequences of ``length`` ids; only the last sequence can be short.

    The first pass encodes each document and sums each task's ids; the running total over the tasks gives every task,
    and so every document, its place in the stream.  The second pass cuts at multiples of ``length``: a document
    that crosses a border yields one boundary record on each side.  No document is moved: the stream follows the tasks'
    order of reading, and nothing but one number per task reaches the driver.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (``with_ids``: also ``ids``).

    Defined cases: null or empty text is the end id alone; repeated rows and ids are packed once each, a null id is
    kept; a document longer than a sequence fills as many as it needs; an empty table gives no rows; other columns are
    ignored.
    """
    staged = staged_ids(docs, tokenizer, id_col, text_col, end_id)
    bases = part_bases(staged)
    kind = staged.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            at, starts, lengths, crcs, totals, kept = [], [], [], [], [], []
            parts = batch.column(1).to_numpy(zero_copy_only=False)
            begins = bases[parts] + batch.column(2).to_numpy(zero_copy_only=False)
            for row, begin in enumerate(begins.tolist()):
                ids = widened(batch.column(4)[row].as_py(), batch.column(3)[row].as_py())
                view = memoryview(ids).cast("B") if len(ids) else b""
                done = 0
                while done < len(ids):
                    take = min(len(ids) - done, length - (begin + done) % length)
                    piece = view[4 * done : 4 * (done + take)]
                    at.append(row), starts.append(done), lengths.append(take), totals.append(len(ids))
                    crcs.append(zlib.crc32(piece))
                    if with_ids:
                        kept.append(ids[done : done + take].astype(np.int32))
                    done += take
            where = begins[np.array(at, np.int64)] + np.array(starts, np.int64)
            columns = [
                batch.column(0).take(pa.array(at, pa.int64())),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(crcs, pa.int64()),
                pa.array(totals, pa.int64()),
                pa.array(where // length),
                pa.array(where % length),
            ]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns, names = [*columns, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
        "offset bigint" + ", ids array<int>" * with_ids
    )
    return staged.select("doc_id", "part", "local_start", "n_tokens", "ids").mapInArrow(cut, schema)
