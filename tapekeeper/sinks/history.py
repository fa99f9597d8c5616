"""History laid out for lookups by gap: files of neighbouring ids, and an index of the ids each file holds.

A load's files are written first; the rows of the index that name them, one small file, make them visible. Filling gaps then
opens only files whose ids a gap meets: two gaps at both ends of a long history read two files, not all between.
"""

import math
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tapekeeper.operators.dedup import dedup_latest
from tapekeeper.operators.gaps import explode_steps
from tapekeeper.operators.heal import rows_in_gaps
from tapekeeper.schema import KEY, TRADES, VERSION
from tapekeeper.sinks.tables import new_writer, plain_timestamps

# Rows of a file, and ids of a step by which files and gaps find each other.
ROWS, STEP = 1 << 20, 1 << 20

# Of a file and a symbol: the ids it holds, and the number of the load that wrote it.
INDEX = "file string, symbol string, first_id bigint, last_id bigint, rows bigint, load bigint"
STORED = T.StructType(TRADES.fields + [T.StructField("load", T.LongType())])


class StoredHistory(NamedTuple):
    """A history at ``path``; it takes the place of a history table in a healing cycle."""

    spark: SparkSession
    path: str

    def index(self) -> DataFrame:
        """Which ids of which symbol each file holds; empty before the first load."""
        try:
            return self.spark.read.schema(INDEX).parquet(f"{self.path}/index")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], INDEX)

    def load(self, rows: DataFrame, rows_per_file: int = ROWS) -> int:
        """Adds rows, and returns how many files they became. One load at a time.

        Copies of a key become one row, so that a range of ids has a bounded number of rows and a hot symbol, or
        a key with very many copies, still spreads over files of equal size. Rows without symbol or id can fill no gap and are left out.
        """
        number = self.index().agg(F.coalesce(F.max("load"), F.lit(0))).first()[0] + 1
        unique = dedup_latest(rows.select(*TRADES.names).filter("symbol is not null and trade_id is not null"))
        folder, files = f"{self.path}/data/{new_writer('load')}", max(1, math.ceil(unique.count() / rows_per_file))
        plain_timestamps(self.spark)
        unique.withColumn("load", F.lit(number).cast("long")).repartitionByRange(files, *KEY).sortWithinPartitions(*KEY).write.parquet(folder)
        held = self.spark.read.schema(STORED).parquet(folder).groupBy(F.col("_metadata.file_path").alias("file"), "symbol").agg(
            F.min("trade_id").alias("first_id"), F.max("trade_id").alias("last_id"), F.count(F.lit(1)).alias("rows"), F.max("load").alias("load"))
        held.coalesce(1).write.mode("append").parquet(f"{self.path}/index")
        return files

    def files(self, gaps: DataFrame, step: int = STEP) -> list[str]:
        """The files that hold ids between a gap's ends: an equi-join of the index with the gaps on (symbol, id div step).

        Only their names come to the driver, as in any scan.
        """
        def steps(df, low, high):
            return explode_steps(df, "_step", F.expr(f"{low} div {step}"), F.expr(f"{high} div {step}"), 1)

        wanted = steps(gaps.select("symbol", "gap_start", "gap_end"), "gap_start", "gap_end")
        held = steps(self.index().select("file", "symbol", "first_id", "last_id"), "first_id", "last_id")
        met = held.join(wanted, ["symbol", "_step"]).filter("gap_start <= last_id and gap_end >= first_id")
        return sorted(r.file for r in met.select("file").distinct().collect())

    def fill(self, plan: DataFrame) -> DataFrame:
        """The history's rows whose id lies in a gap marked HEAL, each once: the highest version, then the latest load.

        The files are looked up now; a later load does not change the rows.
        """
        gaps = plan.filter("action = 'HEAL'").select("symbol", "gap_start", "gap_end")
        names = self.files(gaps)
        rows = self.spark.read.schema(STORED).parquet(*names) if names else self.spark.createDataFrame([], STORED)
        return dedup_latest(rows_in_gaps(gaps, rows), KEY, VERSION, ["load"]).drop("load")
