"""Kernels over barcodes as streams of sorted rows: only the short rows are exchanged, once, and many barcodes share a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Kernel = Callable[[Iterator[tuple]], Iterable[tuple]]


def by_barcode(rows: DataFrame, kernel: Kernel, schema: StructType, *order: str, batch: int = 4096) -> DataFrame:
    """What ``kernel`` yields for each barcode but null, from an iterator over its rows sorted by ``order``; ``barcode`` is the first column of both.

    Nothing of a barcode is held but what the kernel keeps of it. A sequence cut into words inside Spark grows by two orders, and
    its size is estimated from the uncut one: a join of words is broadcast through the driver, or exchanges them all.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, kinds = to_arrow_schema(schema), to_arrow_schema(schema).types
        each = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        found = ((barcode, *row) for barcode, own in groupby(each, key=lambda row: row[0]) for row in kernel(row[1:] for row in own))
        while part := list(islice(found, batch)):
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*part, strict=True), kinds, strict=True)], schema=out)

    return rows.filter("barcode is not null").repartition(n, "barcode").sortWithinPartitions("barcode", *order).mapInArrow(run, schema)
