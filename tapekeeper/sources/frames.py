"""Exchange frames (JSON text) and topic messages (binary envelope) to typed trades."""

from pyspark.sql import Column, DataFrame, functions as F

from tapekeeper.schema import TRADE_MESSAGE
from tapekeeper.sources.intake import REASON, first_reason, type_trades

# Frame keys of each trade field, and the byte that opens a message envelope.
FRAME_KEYS = {"symbol": "s", "trade_id": "t", "price": "p", "quantity": "q", "trade_time": "T"}
MAGIC = "00"


def parse_frames(df: DataFrame, column: str = "raw") -> DataFrame:
    """Trade frames as typed rows plus ``reason``; frames of any other kind are left out.

    The payload is the object under ``data``, or the frame itself where it has no ``data``. Each
    frame is parsed once, into a variant, whose paths tell ``t`` from ``T``. Text that is not one
    whole JSON object, or whose ``data`` is none, comes out with a reason. The frame is parsed as the
    only item of a list, so that text after it shows.
    """
    keys = {"kind": "e", **FRAME_KEYS}
    raw = F.col(column).alias("raw")
    read = df.select(raw, F.try_parse_json(F.concat(F.lit("["), column, F.lit("]"))).alias("_v"))

    def at(path, kind="string"):
        return F.try_variant_get("_v", path, kind)

    def is_object(path):
        return F.coalesce(F.startswith(F.schema_of_variant(at(path, "variant")), F.lit("OBJECT")), F.lit(False))

    has_data = at("$[0].data", "variant").isNotNull()
    whole = is_object("$[0]") & at("$[1]", "variant").isNull() & F.endswith(F.rtrim("raw"), F.lit("}"))
    sound = F.coalesce(whole & (~has_data | is_object("$[0].data")), F.lit(False))
    fields = read.select("raw", (~sound).alias("_broken"), *[
        F.when(has_data, at(f"$[0].data.{key}")).otherwise(at(f"$[0].{key}")).alias(name) for name, key in keys.items()])
    wanted = fields.filter((F.col("kind") == "trade") | F.col("_broken"))
    return type_trades(wanted.withColumn(
        REASON, F.when(F.col("_broken"), F.lit("not a JSON object"))), keep=["raw"])


def split_envelope(df: DataFrame, column: str = "value") -> DataFrame:
    """Adds magic, schema_id and payload: one zero byte, a 4-byte big-endian id, then the record.

    ``reason`` is set for a message that is too short or opens with another byte.
    """
    value = F.col(column)
    opened = df.withColumns({
        "magic": F.hex(F.substring(value, 1, 1)),
        "schema_id": F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long"),
        "payload": F.expr(f"substring({column}, 6)"),
    })
    return opened.withColumn(REASON, first_reason(
        (value.isNull() | (F.length(value) < 5), "short message"), (F.col("magic") != MAGIC, "bad magic byte")))


def avro_payload(payload: Column, schema: str) -> Column:
    """Decode one payload with its writer's Avro schema; needs the spark-avro package on the cluster."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(payload, schema, {"mode": "PERMISSIVE"})


def json_payload(payload: Column, schema: str) -> Column:
    """Decode one payload that holds the record as JSON text; ``schema`` is a DDL string."""
    return F.from_json(payload.cast("string"), schema)


def decode_trades(df: DataFrame, schemas: dict[int, str], column: str = "value", decode=avro_payload) -> DataFrame:
    """Envelope messages to typed trades plus ``reason``, each decoded with the schema its id names.

    ``schemas`` maps writer schema id to schema; a message with an unknown id or an undecodable
    payload gets a reason instead of stopping the stream.
    """
    opened = split_envelope(df, column)
    empty = F.lit(None).cast("struct<" + ",".join(f"{name}:string" for name in TRADE_MESSAGE.names) + ">")
    record, known = empty, F.lit(False)
    for schema_id, schema in schemas.items():
        here = F.col(REASON).isNull() & (F.col("schema_id") == schema_id)
        fields = F.transform(F.array(decode(F.col("payload"), schema)), lambda body: F.when(
            body.isNotNull(), F.struct(*[body[name].cast("string").alias(name) for name in TRADE_MESSAGE.names])))
        record = F.when(here, fields[0]).otherwise(record)
        known = known | (F.col("schema_id") == schema_id)
    # Exploding the one record makes it a value: filters on its fields do not decode it again.
    opened = opened.withColumn("_known", known).select("*", F.explode(F.array(record)).alias("_record"))
    reason = F.coalesce(F.col(REASON), first_reason(
        (~F.col("_known"), "unknown schema id"), (F.col("_record").isNull(), "undecodable payload")))
    raw = opened.select(*[F.col(f"_record.{name}").alias(name) for name in TRADE_MESSAGE.names],
                        reason.alias(REASON), F.col(column).alias("raw"))
    return type_trades(raw, keep=["raw"])
