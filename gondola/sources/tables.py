"""Stored tables that take batches of upserts, deletes and updates, each as a new version.

A table is a folder of Parquet files that each own a range of keys, and of version files that list
them. A batch rewrites only the files whose ranges hold its keys (keys that are spread over all
ranges rewrite all of them) and then names the new set in the next version file. That file is
written beside its place and renamed there, which fails if another writer was first; a batch that
fails before leaves the old version as it is. Readers take the newest version, or an older one.

Defined cases: a null key is smaller than all others; an empty batch makes no version; an empty
table has one file without rows. Keys are compared as strings or numbers, as Spark orders them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.operators.merge import upsert as merged

#: Rows of a file about, where the caller doesn't say.
FILE_ROWS = 1_000_000
#: Files that a task writes at most, one after the other: a task of its own for each costs more than a small file.
TASK_FILES = 64
#: Files of a table at most: their bounds are compared in the plan, and the driver holds a line of each.
MAX_FILES = 10_000


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def versions(spark: SparkSession, path: str) -> list[int]:
    files, at = _files(spark, f"{path}/versions")
    if not files.exists(at):
        return []
    names = [s.getPath().getName() for s in files.listStatus(at)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def _manifest(spark: SparkSession, path: str, version: int | None) -> tuple[int, dict]:
    there = versions(spark, path)
    version = there[-1] if version is None else version
    return version, json.loads(spark.read.text(f"{path}/versions/{version}.json", wholetext=True).first()["value"])


def _commit(spark: SparkSession, path: str, version: int, manifest: dict) -> None:
    """Write the version file beside its place and rename it; an error if that version is there already."""
    jvm, text = spark._jvm, json.dumps(manifest).encode()
    files, _ = _files(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}/versions/_{uuid.uuid4().hex}")
    out = files.create(beside, False)
    out.write(text)
    out.close()
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(beside), files.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{path}/versions/{version}.json")), none)


def _at_or_below(value: Column, ascending: list, kind: str) -> Column:
    """How many of the ascending values are at or below the value (none for a null), by halving: the work a row grows with the number's logarithm."""
    # one literal, however many values there are
    held = F.from_json(F.lit(json.dumps(ascending)), f"array<{kind}>")
    first = F.struct(F.lit(0).alias("low"), F.lit(len(ascending)).alias("high"))

    def halve(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["low"] + at["high"], 1)
        below = F.coalesce(F.get(held, middle) <= value, F.lit(False))
        low = F.when((at["low"] < at["high"]) & below, middle + 1).otherwise(at["low"])
        high = F.when((at["low"] < at["high"]) & ~below, middle).otherwise(at["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    steps = F.sequence(F.lit(1), F.lit(len(ascending).bit_length()))
    return F.aggregate(steps, first, halve, lambda at: at["low"])


def _owner(key: Column, lows: list, kind: str) -> Column:
    """Which file's range holds the key: the number of lower bounds after the first at or below it."""
    return F.lit(0) if len(lows) < 2 else _at_or_below(key, lows[1:], kind)


def _write(rows: DataFrame, key: str, path: str, owners: list[int]) -> dict[int, list]:
    """rows (with _owner) to a folder of their own, the rows of an owner (of ascending ones) by key in files of their own: owner -> [path, rows]."""
    folder = f"{path}/data/{uuid.uuid4().hex}"
    tasks = min(len(owners), max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-len(owners) // TASK_FILES)))
    place = F.floor((_at_or_below(F.col("_owner"), owners, "int") - 1) * tasks / len(owners)).cast("int")
    rows.repartitionById(tasks, place).sortWithinPartitions("_owner", key).write.partitionBy("_owner").parquet(folder)
    written = rows.sparkSession.read.schema(rows.schema).parquet(folder)
    found = written.groupBy("_owner", F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n")).collect()
    out: dict[int, list] = {}
    for r in found:
        out.setdefault(r["_owner"], []).append([r["file"], r["n"]])
    return out


def create(rows: DataFrame, path: str, key: str, file_rows: int = FILE_ROWS) -> int:
    """A new table, or a new version of a stored one with other bounds; the rows' keys differ."""
    spark = rows.sparkSession
    n = rows.count()
    wanted = min(MAX_FILES, max(1, -(-n // file_rows)))
    lows: list = [None]
    if wanted > 1:  # bounds from a sample of keys of bounded size
        sample = rows.select(key).where(F.col(key).isNotNull()).sample(min(1.0, 100 * wanted / n), seed=1).orderBy(key).collect()
        lows += sorted({sample[k * len(sample) // wanted][key] for k in range(1, wanted)} if sample else set())
    held = rows.withColumn("_owner", _owner(F.col(key), lows, rows.schema[key].dataType.simpleString()))
    written = _write(held, key, path, list(range(len(lows))))
    there = versions(spark, path)
    manifest = {"key": key, "schema": rows.schema.json(), "ranges": [{"low": low, "files": written.get(k, [])} for k, low in enumerate(lows)]}
    _commit(spark, path, there[-1] + 1 if there else 1, manifest)
    return there[-1] + 1 if there else 1


def _rows(spark: SparkSession, manifest: dict, ranges: list[int]) -> DataFrame:
    from pyspark.sql.types import StructType

    schema = StructType.fromJson(json.loads(manifest["schema"]))
    files = [f for k in ranges for f, _ in manifest["ranges"][k]["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version, the newest if none is given."""
    _, manifest = _manifest(spark, path, version)
    return _rows(spark, manifest, list(range(len(manifest["ranges"]))))


def change(spark: SparkSession, path: str, keys: DataFrame, what: Callable[[DataFrame], DataFrame]) -> int:
    """A new version in which the rows of all ranges that hold one of keys are what(those rows); the version's number."""
    version, manifest = _manifest(spark, path, None)
    key, lows = manifest["key"], [r["low"] for r in manifest["ranges"]]
    kind = next(f["type"] for f in json.loads(manifest["schema"])["fields"] if f["name"] == key)
    touched = sorted(r[0] for r in keys.select(_owner(F.col(key), lows, kind).alias("o")).distinct().collect())
    if not touched:
        return version
    rows = what(_rows(spark, manifest, touched)).withColumn("_owner", _owner(F.col(key), lows, kind))
    written = _write(rows, key, path, touched)
    for k in touched:
        manifest["ranges"][k]["files"] = written.get(k, [])
    _commit(spark, path, version + 1, manifest)
    return version + 1


def upsert(spark: SparkSession, path: str, incoming: DataFrame) -> int:
    """Incoming rows (of different keys) replace stored ones of the same key."""
    _, manifest = _manifest(spark, path, None)
    return change(spark, path, incoming, lambda rows: merged(rows, incoming.select(*rows.columns), manifest["key"]))


def delete(spark: SparkSession, path: str, keys: DataFrame) -> int:
    _, manifest = _manifest(spark, path, None)
    return change(spark, path, keys, lambda rows: rows.join(keys.select(manifest["key"]), manifest["key"], "left_anti"))
