"""S5 on CDC targets: the changes of an SCD table as a table that is only appended to.

The silver stream replaces files, so silver itself cannot be read as a stream. Its feed can: ``batch=N`` holds what one
micro-batch changed, a row for each version (keys and ``__START_AT``; the keys alone for type 1) with ``_change``:
``insert`` and ``update`` carry the version as it is now, ``delete`` as it was. A closed version is an update of its
``__END_AT``; a late row that moves a version's start deletes one version and inserts another. Versions that stay as they
were are not in the feed. A batch is staged with the rows it belongs to and moved here by one rename after they have
taken their place, so a batch that is repeated is delivered once, and a stream of the folder gets each change once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators import cdc, dedup
from ..schemas import evolve, fitted, read_stored
from ..storage import list_folders, move_folder

CHANGE, BATCH = "_change", "batch"


def identity(keys: Sequence[str], scd_type: int) -> list[str]:
    """The columns that tell the rows of an SCD table apart."""
    return [*keys] if int(scd_type) == 1 else [*keys, cdc.START_AT]


def _comparable(df: DataFrame, side: str, names: Sequence[str]) -> Column:
    """The named columns as one value; those that Spark cannot compare (maps, variants) as JSON text."""
    parts = []
    for name in names:
        c, kind = F.col(f"{side}.{name}"), df.schema[name].dataType.simpleString()
        parts.append(F.to_json(F.struct(c)) if "map<" in kind or "variant" in kind else c)
    return F.struct(*parts) if parts else F.lit(True)


def changes_between(old: DataFrame | None, new: DataFrame, keys: Sequence[str], scd_type: int = 2) -> DataFrame:
    """The rows of the feed that turn ``old`` into ``new`` (one join on the rows' identity; NULL keys are equal)."""
    if old is None:
        return new.withColumn(CHANGE, F.lit("insert"))
    own = identity(keys, scd_type)
    rest = [c for c in new.columns if c not in own]
    before, after = old.select(*new.columns).withColumn("__there", F.lit(True)), new.withColumn("__there", F.lit(True))
    on = F.lit(True)
    for c in own:
        on = on & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    same = _comparable(new, "l", rest).eqNullSafe(_comparable(new, "r", rest))
    kind = (
        F.when(F.col("l.__there").isNull(), "insert").when(F.col("r.__there").isNull(), "delete").when(~same, "update")
    )
    return before.alias("l").join(after.alias("r"), on, "full_outer").withColumn(CHANGE, kind).filter(
        F.col(CHANGE).isNotNull()).select(
        *[F.when(F.col("r.__there").isNull(), F.col(f"l.{c}")).otherwise(F.col(f"r.{c}")).alias(c) for c in new.columns], CHANGE)


def stage_changes(spark: SparkSession, changes: DataFrame, stage: str, feed: str) -> None:
    """Write a batch's changes below ``stage`` under the number that it will have in the feed."""
    number = 1 + max((int(name.partition("=")[2]) for name in list_folders(spark, feed)), default=-1)
    schema = evolve(spark, feed, StructType([*changes.schema.fields, StructField(BATCH, IntegerType())]))
    rows = fitted(changes, StructType([f for f in schema if f.name != BATCH]))
    rows.write.mode("overwrite").parquet(f"{stage}/{BATCH}={number}")


def publish_changes(spark: SparkSession, stage: str, feed: str) -> None:
    """Move what is staged into the feed; a batch that was moved before is no longer staged."""
    for name in list_folders(spark, stage):
        move_folder(spark, f"{stage}/{name}", f"{feed}/{name}")


def read_feed(spark: SparkSession, feed: str) -> DataFrame:
    """All changes so far. ``stream_table`` reads the same folder as a stream."""
    return read_stored(spark, feed)


def replay(changes: DataFrame, keys: Sequence[str], scd_type: int = 2) -> DataFrame:
    """The SCD table that a feed's changes lead to: the newest change of each row, unless that deletes it."""
    newest = dedup.latest_per_key(changes, identity(keys, scd_type), [BATCH])
    return newest.filter(F.col(CHANGE) != "delete").drop(CHANGE, BATCH)
