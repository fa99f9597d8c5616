"""Messages of several schema versions in one stream, and the versions that a reader must refuse.

A schema is a record in the JSON form of the contract: fields with a name, a type (or a list of types, one of them
"null") and maybe a default. Which versions a reader can take is decided from the schemas alone, before any row flows.
"""

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tapekeeper.schema import TRADE_MESSAGE
from tapekeeper.sources.frames import split_envelope
from tapekeeper.sources.intake import REASON, first_reason, type_trades

# The contract's types in Spark, and what a type may be read as besides itself.
TYPES = {"string": "string", "int": "int", "long": "bigint", "float": "float", "double": "double", "boolean": "boolean", "bytes": "binary"}
WIDER = {"int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",)}


class Incompatible(ValueError):
    """A writer schema that the reader cannot take; says why."""


class Field(NamedTuple):
    type: str
    nullable: bool
    has_default: bool
    default: object


def fields(schema: str) -> dict[str, Field]:
    """The fields of a record schema by name."""
    try:
        listed = json.loads(schema)["fields"]
        found = {}
        for field in listed:
            types = field["type"] if isinstance(field["type"], list) else [field["type"]]
            (kind,) = [t for t in types if t != "null"]
            found[field["name"]] = Field(kind, "null" in types, "default" in field, field.get("default"))
    except (ValueError, KeyError, TypeError) as error:
        raise Incompatible("not a record of plain fields") from error
    if len(found) < len(listed) or unknown(found):
        raise Incompatible(f"unknown type of {', '.join(unknown(found))}" if unknown(found) else "a field twice")
    return found


def unknown(found: dict[str, Field]) -> list[str]:
    return [name for name, field in found.items() if not isinstance(field.type, str) or field.type not in TYPES]


def objections(reader: str, writer: str) -> list[str]:
    """Why records of ``writer`` cannot be read as ``reader``; nothing if they can.

    A field the writer lacks needs a default, a type may stay or widen, and what may be null needs a reader that allows it.
    Fields that only the writer has are left out.
    """
    try:
        theirs = fields(writer)
    except Incompatible as error:
        return [str(error)]
    found = []
    for name, field in fields(reader).items():
        if name not in theirs:
            found += [] if field.has_default else [f"no {name}, which has no default"]
        elif field.type != theirs[name].type and field.type not in WIDER.get(theirs[name].type, ()):
            found.append(f"{name} is {theirs[name].type} instead of {field.type}")
        elif theirs[name].nullable and not field.nullable:
            found.append(f"{name} may be null")
    return found


def ddl(schema: str) -> str:
    """A record schema as Spark's column list."""
    return ", ".join(f"`{name}` {TYPES[field.type]}" for name, field in fields(schema).items())


def json_record(payload: Column, schema: str) -> Column:
    """Decode one payload that holds the record as JSON text."""
    return F.from_json(payload.cast("string"), ddl(schema))


def decode_versions(df: DataFrame, schemas: dict[int, str], reader: str, column: str = "value", decode=json_record,
                    set_aside: bool = False) -> DataFrame:
    """Envelope messages to typed trades plus ``reason``, each decoded with its writer's schema and read as ``reader``.

    Versions that ``reader`` cannot take stop the call; with ``set_aside`` their messages get a reason that says why, and the
    other versions flow. Messages with an unknown id or an undecodable payload get a reason as well.
    """
    refused = {number: why for number, schema in schemas.items() if (why := objections(reader, schema))}
    if refused and not set_aside:
        raise Incompatible("; ".join(f"schema {number}: {', '.join(why)}" for number, why in sorted(refused.items())))
    opened, wanted = split_envelope(df, column), fields(reader)
    record = F.lit(None).cast("struct<" + ",".join(f"{name}:string" for name in TRADE_MESSAGE.names) + ">")
    tests = [(~F.col("schema_id").isin(sorted(schemas)), "unknown schema id")]
    for number, schema in schemas.items():
        here = F.col(REASON).isNull() & (F.col("schema_id") == number)
        if number in refused:
            tests.append((F.col("schema_id") == number, f"schema refused: {', '.join(refused[number])}"))
            continue
        theirs = fields(schema)

        def read(body, name):
            fill = F.lit(None if name not in wanted or wanted[name].default is None else str(wanted[name].default)).cast("string")
            return (body[name].cast("string") if name in theirs else fill).alias(name)

        filled = F.transform(F.array(decode(F.col("payload"), schema)), lambda body: F.when(
            body.isNotNull(), F.struct(*[read(body, name) for name in TRADE_MESSAGE.names])))
        record = F.when(here, filled[0]).otherwise(record)
    # Exploding the one record makes it a value: filters on its fields do not decode it again.
    decoded = opened.select("*", F.explode(F.array(record)).alias("_record"))
    reason = F.coalesce(F.col(REASON), first_reason(*tests, (F.col("_record").isNull(), "undecodable payload")))
    raw = decoded.select(*[F.col(f"_record.{name}").alias(name) for name in TRADE_MESSAGE.names], reason.alias(REASON),
                         F.col(column).alias("raw"))
    return type_trades(raw, keep=["raw"])
