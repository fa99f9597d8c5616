"""Helpers the operators share: the folder all executors see, plain text columns, and hashed words."""

import re
import tempfile
import uuid
import zipfile
import zlib
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Tasks that the rows of one group are dealt to.
SALTS = 32

# Words a task remembers the hash of; beyond this many it starts anew, which changes no result.
REMEMBERED = 500_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's checkpoint folder. Only a local master without one gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once per application, as ``--py-files`` would."""
    if spark.sparkContext.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as target:
            for file in sorted(package.rglob("*.py")):
                target.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(spark.sparkContext.applicationId)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: later steps reread it, so a lost executor costs no recomputation."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """The text column, null as empty."""
    return F.coalesce(plain(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def with_groups(rows: DataFrame, key: str, pick) -> DataFrame:
    """Rows (id, key, ...) with ``chosen``, the ``pick`` (F.min or F.max) of their group's ids, and ``group_size``.

    A group's rows are dealt to salts, summed up by salt, and joined back by salt: the rows of one
    key spread over as many tasks, and no group is repeated for salts it doesn't have. Salts go round row by row and are
    written, so rows without an id, or with one id, spread like any other.
    """
    salted = written(rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))), "salted")
    parts = salted.groupBy(key, "salt").agg(pick("id").alias("chosen"), F.count(F.lit(1)).alias("group_size"))
    groups = parts.groupBy(key).agg(pick("chosen").alias("chosen"), F.sum("group_size").alias("group_size"))
    return salted.join(parts.select(key, "salt").join(groups, key), [key, "salt"]).drop("salt")


def split_of(id_column: Column, parts: int) -> Column:
    """The part of a document: crc32 of its id as text, modulo ``parts``."""
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(parts))


def sample_rows(rows: DataFrame, id_name: str, limit: int, by: str | None = None) -> DataFrame:
    """At most ``limit`` rows, or so many for each value of ``by``, in the order of a hash of their id.

    The documented bound of a training sample. Groups are counted first, and only rows whose hash
    lies in a share four times as large as needed are ranked: however large a group, its ranking
    sees some four times ``limit`` rows.
    """
    group = F.lit(0) if by is None else plain(by)
    rows = rows.withColumn("group_", group)
    sizes = written(rows.groupBy("group_").agg(F.count(F.lit(1)).alias("size_")), "sizes")
    place = F.xxhash64(plain(id_name))
    share = F.pmod(place, F.lit(1 << 31)) / F.lit(float(1 << 31))
    near = rows.join(sizes, rows["group_"].eqNullSafe(sizes["group_"])).select(rows["*"], "size_").filter(
        share < F.lit(4.0 * limit) / F.col("size_"))
    order = Window.partitionBy("group_").orderBy(share, plain(id_name))
    return near.withColumn("nth_", F.row_number().over(order)).filter(F.col("nth_") <= limit).drop("nth_", "group_", "size_")


class WordHashes(dict):
    """word -> 32-bit hash, filled as words come and emptied when it has grown too large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return value


def byte_slices(texts: list[str], limit: int):
    """Consecutive (first, last + 1) ranges of texts of at most ``limit`` characters together, one text at least."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text)
    if texts:
        yield first, len(texts)


WORDS = re.compile(r"[^\W\d_]+")


def sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))
