"""Versioned item models and related datasets on a shared file system.

A model lives in ``root/name/v=<milliseconds>``; ``root/name/_current`` names the
version readers should open. Publishing writes a complete new version first and then
replaces that small file by an atomic rename, so a failed publish changes nothing
and a reader never sees half a model. One publisher per name at a time.
"""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUNDLE = ("user_factors", "item_factors", "user_index", "item_index", "popularity", "items")
_POINTER = "_current"


class _Folder:
    """The few file operations a publish needs, on whatever file system ``path`` names."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, child: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{child}" if child else self.path)

    def exists(self, child: str) -> bool:
        return self._fs.exists(self._at(child))

    def read(self, child: str) -> str:
        stream = self._fs.open(self._at(child))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, child: str, text: str) -> None:
        draft = self._at(f"{child}.{time.time_ns()}")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        rename = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.getUri(), self._conf
        )
        context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(self._at(child)), options)

    def versions(self) -> list[int]:
        if not self._fs.exists(self._at("")):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(""))]
        return sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())

    def delete(self, child: str) -> None:
        self._fs.delete(self._at(child), True)


def current_version(spark: SparkSession, root: str, name: str) -> int | None:
    """The published version, ``None`` before the first publish."""
    folder = _Folder(spark, f"{root}/{name}")
    if not folder.exists(_POINTER):
        return None
    text = folder.read(_POINTER).split()
    if len(text) != 1 or not text[0].isdigit() or not folder.exists(f"v={text[0]}"):
        raise RuntimeError(f"{root}/{name}: the current version is not exactly one complete model")
    return int(text[0])


def publish_model(model: DataFrame, root: str, name: str, version: int | None = None) -> int:
    """Write ``model`` as the new version of ``name`` and switch readers to it.

    The version just replaced stays until the next publish for readers that opened
    it; older ones and leftovers of failed publishes are removed last.
    """
    spark = model.sparkSession
    folder = _Folder(spark, f"{root}/{name}")
    replaced = current_version(spark, root, name)
    if version is None:
        version = max([int(time.time() * 1000), *(v + 1 for v in folder.versions())])
    model.write.mode("overwrite").parquet(f"{folder.path}/v={version}")
    folder.replace(_POINTER, str(version))
    for old in folder.versions():
        if old < version and old != replaced:
            folder.delete(f"v={old}")
    return version


def read_model(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The current model, ``None`` if none was published."""
    version = current_version(spark, root, name)
    return None if version is None else spark.read.parquet(f"{root}/{name}/v={version}")


def lookup_items(model: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents of the given ``id`` values."""
    return model.join(ids.select("id"), "id", "left_semi")


def save_bundle(frames: dict[str, DataFrame], path: str) -> None:
    """Write related datasets below one path."""
    for name, frame in frames.items():
        frame.write.parquet(f"{path}/{name}")


def load_bundle(spark: SparkSession, path: str, names: Iterable[str] = BUNDLE) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def property_types(
    props: DataFrame, date_names: Iterable[str] = (), rank_names: Iterable[str] = ()
) -> DataFrame:
    """(key, type) of all properties in PROPS.

    Dates and ranks go by name; a key holding any JSON array becomes an array.
    """
    is_array = F.bool_or(F.coalesce(F.ltrim("value").startswith("["), F.lit(False)))
    scalar = (
        F.when(F.col("key").isin(list(date_names)), "timestamp_ntz")
        .when(F.col("key").isin(list(rank_names)), "double")
        .otherwise("string")
    )
    return props.groupBy("key").agg(is_array.alias("_array")).select(
        "key",
        F.when(F.col("_array"), F.concat(F.lit("array<"), scalar, F.lit(">")))
        .otherwise(scalar)
        .alias("type"),
    )


def model_fields(
    maps: DataFrame, date_names: Iterable[str] = (), rank_names: Iterable[str] = ()
) -> DataFrame:
    """(key, type) of all properties in (item, props MAP)."""
    return property_types(maps.select(F.explode("props").alias("key", "value")), date_names, rank_names)


def field_types(fields: DataFrame) -> dict[str, str]:
    """The discovered schema on the driver: one entry per property name."""
    return {r["key"]: r["type"] for r in fields.orderBy("key").collect()}
