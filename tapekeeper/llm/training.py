"""Fetching the features of a bounded sample of labelled rows, on which the small models are fitted."""

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tapekeeper.llm.shared import plain, text_of


def row_mark(text_column: str = "text") -> Column:
    """What tells rows that share an id apart in training: a hash of their text."""
    return F.xxhash64(text_of(text_column))


class Example(NamedTuple):
    label: object
    places: np.ndarray    # hashed features, each once
    values: np.ndarray


def examples(docs: DataFrame, labels: DataFrame, features: Callable[[], Callable[[str], tuple[np.ndarray, np.ndarray]]],
             id_column: str = "doc_id", text_column: str = "text") -> list[Example]:
    """Features of the whole texts of labelled rows, in the order of the ids, for fitting on the driver.

    ``labels`` has (id, label) and at most as many rows as the caller's documented bound, which is
    also why it may be broadcast. With a column ``mark`` a label belongs to the rows of that id and ``row_mark``; without,
    to the id, and of several rows that share it the one with the smallest mark is taken. Either way a label gives
    one example. ``features()`` is called once per task and returns the function from a text to (places, values).
    """
    marked = "mark" in labels.columns

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = features()
        for batch in batches:
            found = [of(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array([p.astype("<u4").tobytes() for p, _ in found], pa.binary()),
                 pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())],
                names=["id", "label", "mark", "places", "values"])

    rows = docs.select(plain(id_column).alias("id"), text_of(text_column).alias("text"), row_mark(text_column).alias("mark"))
    rows = rows.join(F.broadcast(labels), ["id", "mark"] if marked else "id").select("id", "label", "text", "mark")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    shape = f"id {kinds['id']}, label {kinds['label']}, mark bigint, places binary, values binary"
    found = rows.mapInArrow(extract, shape).groupBy("id", "label", *(["mark"] if marked else [])).agg(
        F.min(F.struct("mark", "places", "values")).alias("row"))
    fetched = found.select("id", "label", "row.*").orderBy("id", "mark", "label").toArrow()
    return [Example(r["label"], np.frombuffer(r["places"], "<u4"), np.frombuffer(r["values"], "<f4"))
            for r in fetched.select(["label", "places", "values"]).to_pylist()]


def stacked(rows: list[Example]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row number, place, value) of all features of all rows."""
    sizes = [len(r.places) for r in rows]
    join = lambda parts, kind: np.concatenate([*parts, np.empty(0, kind)])
    return (np.repeat(np.arange(len(rows)), sizes), join([r.places for r in rows], "<u4").astype(np.int64),
            join([r.values for r in rows], "<f4").astype(np.float64))
