"""Vector code compression: product codes by integer Lloyd rounds over cover trees.

Components become integers floor(1024 x); vectors are cut into equal parts, and each part has
a codebook of ``entries`` integer vectors. Every step is exact integer arithmetic, so results
do not depend on how the vectors are dealt to tasks.

1. Blocks of at most ``BLOCK`` vectors inside each input partition become one cover tree per
   part (``cover_tree``), built once and written with the vectors in tree order.
2. A round assigns whole subtrees to their nearest entry by the triangle inequality, adding
   their cumulative sums; only ambiguous nodes descend to exact comparisons. A task returns a
   number and a sum per entry; those add up in Spark, and ``parts * entries`` rows reach the
   driver, whatever the number of vectors.
3. An entry becomes the floor of its mean, an unused one stays; after the last round parts are
   assigned again for the codes and errors.

Defined results: rows whose vector is NULL or holds a NULL or non-finite component are left out,
as are those whose length is not that of the first kept vector (by id). Ids order codebook
seeds, NULLs last, equal ids by their vectors; with fewer vectors than entries, codebooks are as
small. Repeated rows count as often as they stand. Integers are clipped to +-2**26 (components
beyond +-65536), which keeps 64-bit sums exact. Equal labels, NULLs too, share a label error. An
empty table gives no rows. Other columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import staged
from terrace.llm.cover_tree import assign, build, squared

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE, LIMIT = 1024.0, 1 << 26
BLOCK = 2048


def _integers(vector: Column) -> Column:
    """floor(1024 x) of every component, NULL for a vector that is left out."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), x.cast("double") * SCALE))).cast("int"))
    return F.when(~bad & (F.size(vector) > 0), whole)


def _trees(rows: DataFrame, parts: int) -> DataFrame:
    """One row per block: its rows, and per part the points in tree order, the order, nodes and radii."""
    kind = rows.schema["_row"].dataType.simpleString()

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        points = batch.column("_ints").flatten().to_numpy().reshape(n, -1)
        found = [build(p.astype(np.int64)) for p in np.split(points, parts, axis=1)]
        cut = [p[o] for p, (o, _, _) in zip(np.split(points, parts, axis=1), found, strict=True)]
        own = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column("_row"))
        lists = [
            pa.array([[np.ascontiguousarray(x).astype(t).tobytes() for x in xs]], pa.list_(pa.binary()))
            for xs, t in ((cut, np.int32), ([f[0] for f in found], np.int32), ([f[1] for f in found], np.int32), ([f[2] for f in found], np.float64))
        ]
        return pa.RecordBatch.from_arrays([own, *lists], ["rows", "points", "places", "nodes", "radii"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                full = whole.num_rows - whole.num_rows % BLOCK
                for at in range(0, full, BLOCK):
                    yield block(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in whole.slice(at, BLOCK).columns], whole.schema.names))
                held = [whole.slice(full)]
        held = [b for b in held if b.num_rows]
        if held:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield block(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in whole.columns], whole.schema.names))

    blobs = ", ".join(f"{c} array<binary>" for c in ("points", "places", "nodes", "radii"))
    return rows.mapInArrow(work, f"rows array<{kind}>, {blobs}")


def _block(batch: pa.RecordBatch, row: int, part: int, width: int):
    blob = lambda name, t: np.frombuffer(batch.column(name)[row][part].as_buffer(), t)
    points = blob("points", np.int32).reshape(-1, width).astype(np.int64)
    return points, blob("places", np.int32), blob("nodes", np.int32).reshape(-1, 6).astype(np.int64), blob("radii", np.float64)


def _round(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks after one assignment of all parts and the update of the entries."""
    width = books[0].shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for row in range(batch.num_rows):
                for part, book in enumerate(books):
                    points, _, nodes, radii = _block(batch, row, part, width)
                    _, count, total, _ = assign(points, nodes, radii, book)
                    counts[part] += count
                    sums[part] += total
        for part, (count, total) in enumerate(zip(counts, sums, strict=True)):
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), part, np.int32)), pa.array(used.astype(np.int32)), pa.array(count[used])]
                + [pa.array(total[used, i]) for i in range(width)],
                ["part", "entry", "n", *(f"s{i}" for i in range(width))],
            )

    columns = ["n", *(f"s{i}" for i in range(width))]
    found = trees.select("points", "places", "nodes", "radii").mapInArrow(work, ", ".join(["part int", "entry int", *(f"{c} long" for c in columns)]))
    new = [b.copy() for b in books]
    for part, entry, n, *total in found.groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in columns)).collect():
        new[part][entry] = [t // n for t in total]
    return new


def _coded(trees: DataFrame, books: list[np.ndarray], kind: str) -> DataFrame:
    """(_row, _code, _error) of every vector under the final codebooks."""
    width = books[0].shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own = batch.column("rows")[row].values
                codes = np.zeros((len(own), len(books)), np.uint8)
                error = np.zeros(len(own), np.int64)
                for part, book in enumerate(books):
                    points, places, nodes, radii = _block(batch, row, part, width)
                    code, _, _, _ = assign(points, nodes, radii, book)
                    codes[places, part] = code
                    error[places] += ((points - book[code]) ** 2).sum(1)
                names = [bytes(c).hex() for c in codes]
                yield pa.RecordBatch.from_arrays([own, pa.array(names, pa.string()), pa.array(error)], ["_row", "_code", "_error"])

    return trees.mapInArrow(work, f"_row {kind}, _code string, _error long")


def compress(
    vectors: DataFrame, *, vector: str = "embedding", id_col: str = "vec_id", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all vectors, and the codebooks (one array of entries per part).

    The rows have the caller's columns, but for the vector, and ``_code`` (two hex digits a part),
    ``_error`` (squared distance to the code) and ``_label_error`` (errors added over the label).
    """
    if entries > 256:
        raise ValueError("a code has one byte a part: at most 256 entries")
    others = [c for c in vectors.columns if c != vector]
    packed = vectors.select(
        F.struct(*others).alias("_row"), F.col(id_col).alias("_id"), F.col(label).alias("_label"), _integers(F.col(vector)).alias("_ints")
    ).filter("_ints is not null")
    by_id = [F.col("_id").asc_nulls_last(), F.col("_ints")]
    kind = packed.schema["_row"].dataType.simpleString()
    lead = packed.select("_id", "_ints").orderBy(*by_id).limit(1).collect()
    if not lead:
        empty = vectors.sparkSession.createDataFrame([], f"_row {kind}, _code string, _error long, _label_error long")
        return empty.select("_row.*", "_code", "_error", "_label_error"), [np.zeros((0, 0), np.int64)] * parts
    dims = len(lead[0]["_ints"])
    if dims % parts:
        raise ValueError(f"vectors of length {dims} cannot be cut into {parts} equal parts")
    kept = packed.filter(F.size("_ints") == dims)
    seeds = kept.select("_id", "_ints").orderBy(*by_id).limit(entries).collect()
    books = np.split(np.array([s["_ints"] for s in seeds], np.int64), parts, axis=1)
    trees = staged(_trees(kept.select("_row", "_ints"), parts), "vector-trees")
    for _ in range(rounds):
        books = _round(trees, books)
    coded = staged(_coded(trees, books, kind), "vector-codes")
    by_label = coded.groupBy(F.col(f"_row.{label}").alias("_label")).agg(F.sum("_error").alias("_label_error"))
    out = coded.join(by_label, F.col(f"_row.{label}").eqNullSafe(F.col("_label")))
    return out.select("_row.*", "_code", "_error", "_label_error"), books


def book_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()
