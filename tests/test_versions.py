"""Schema versions: what a reader can take, what it refuses and why; and the stored progress of streams."""

import json

import pytest
from pyspark.sql import functions as F

from tapekeeper.schema import TRADES
from tapekeeper.sources.tables import read_trades
from tapekeeper.sources.versions import Incompatible, decode_versions, objections
from tapekeeper.sinks.tables import read_peaks
from tapekeeper.streaming.trades import _offsets, append_progress, read_progress, write_live_peaks, write_trades
from tests.helpers import ids_of, tape_of, trade, tuples


def record(**kinds):
    return json.dumps({"type": "record", "name": "T", "fields": [
        {"name": n, "type": k[0], "default": k[1]} if isinstance(k, tuple) else {"name": n, "type": k} for n, k in kinds.items()]})


BASE = {"symbol": "string", "trade_id": "long", "price": "string", "quantity": "string", "trade_time": "long"}


@pytest.mark.parametrize("writer, why", [
    (BASE, []),
    ({**BASE, "venue": "string"}, []),
    ({**BASE, "trade_id": "int"}, []),
    ({**BASE, "trade_id": "string"}, ["trade_id is string instead of long"]),
    ({**BASE, "trade_id": "double"}, ["trade_id is double instead of long"]),
    ({**BASE, "price": ["null", "string"]}, ["price may be null"]),
    ({k: v for k, v in BASE.items() if k != "price"}, ["no price, which has no default"]),
    ({**BASE, "price": {"type": "bytes"}}, ["unknown type of price"]),
])
def test_objections(writer, why):
    assert objections(record(**BASE), record(**writer)) == why


def test_broken_schemas_are_objected_to():
    for text in ("", "[]", '{"type": "record"}', '{"fields": [{"name": "a"}]}', '{"fields": [{"name": "a", "type": ["int", "long"]}]}'):
        assert objections(record(**BASE), text) == ["not a record of plain fields"]
    assert objections(record(**BASE, more=("string", "x")), record(**BASE)) == []


def message(number, body):
    return bytes([0]) + number.to_bytes(4, "big") + body.encode()


def test_versions_flow_side_by_side_and_a_breaking_one_does_not(spark):
    full = {"symbol": "A", "trade_id": 7, "price": "1.5", "quantity": "2", "trade_time": 1000}
    less = {k: v for k, v in full.items() if k != "quantity"}
    reader = record(**{**BASE, "quantity": ("string", "9")})
    writers = {1: record(**{k: v for k, v in BASE.items() if k != "quantity"}), 2: record(**BASE), 3: record(**{**BASE, "trade_time": "string"})}
    rows = [(message(1, json.dumps(less)),), (message(2, json.dumps(full)),), (message(3, json.dumps(full)),), (message(4, "{}"),),
            (message(2, "broken"),), (b"x",), (None,)]
    df = spark.createDataFrame(rows, "value binary")
    with pytest.raises(Incompatible, match="schema 3: trade_time is string instead of long"):
        decode_versions(df, writers, reader)
    found = decode_versions(df, writers, reader, set_aside=True).collect()
    assert [(r.trade_id, None if r.quantity is None else float(r.quantity)) for r in found[:2]] == [(7, 9.0), (7, 2.0)]
    assert [r.reason for r in found[:4]] == [None, None, "schema refused: trade_time is string instead of long", "unknown schema id"]
    assert all(r.reason for r in found[4:]) and len(found) == len(rows)


def test_live_peaks_and_progress_over_a_restart(spark, tmp_path):
    source, out, marks, progress = (str(tmp_path / n) for n in ("source", "peaks", "marks", "progress"))
    for number, price in enumerate(("5", "9", "7")):
        tape_of(spark, trade("A", number, price), trade("B", number, "1")).coalesce(1).write.mode("append").parquet(source)
        stream = read_trades(spark, "parquet", TRADES, path=source, maxFilesPerTrigger=1)
        write_live_peaks(stream, out, marks, None).awaitTermination()
        query = write_trades(stream, str(tmp_path / "t"), str(tmp_path / "m"), flush=None)
        query.awaitTermination()
        for _ in range(2):
            append_progress(spark, query, progress)
    assert tuples(read_peaks(spark, out)) == [("A", 9.0), ("B", 1.0)]
    told = read_progress(spark, progress)
    assert told.select("query_id").distinct().count() == 1 and told.agg(F.sum("input_rows")).first()[0] == 6
    assert told.filter("behind is not null").isEmpty()


def test_offsets_by_partition():
    assert _offsets('{"t": {"0": 5, "1": 7}}') == {("t", "0"): 5, ("t", "1"): 7}
    assert _offsets({"logOffset": 3}) == _offsets(None) == _offsets("3") == {}
