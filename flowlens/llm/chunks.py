"""Arrow batches of documents as blocks of bounded size, for ``mapInArrow`` functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def text_blocks(batches: Iterable[pa.RecordBatch], chars: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts (null as empty) of rows in order; a block ends when it holds ``chars`` characters."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            value = text.as_py() or ""
            ids.append(doc_id)
            texts.append(value)
            size += len(value)
            if size >= chars:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def unused(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until ``docs`` has no such column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def append_columns(
    docs: DataFrame,
    fields: dict[str, tuple[str, pa.DataType]],
    start: Callable[[], Callable[[list[str]], list[list]]],
    chars: int,
) -> DataFrame:
    """All columns of ``docs`` and further ones computed from ``text``, in place.

    ``start()`` makes, once per task, a function from a block of texts (null as empty) to one list per field.
    """
    added = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, (kind, _) in fields.items()))
    schema = StructType([*docs.schema.fields, *added.fields])
    kinds = [kind for _, kind in fields.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process = start()
        for batch in batches:
            found: list[list] = [[] for _ in kinds]
            rows = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows), batch.column("text")], ["id", "text"])
            for _, texts in text_blocks([rows], chars):
                for whole, part in zip(found, process(texts)):
                    whole.extend(part)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(x, kind) for x, kind in zip(found, kinds)]],
                [*batch.schema.names, *fields],
            )

    return docs.mapInArrow(run, schema)
