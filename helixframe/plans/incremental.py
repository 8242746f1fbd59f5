"""A job over files that computes again only what belongs to changed files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.report import stale_inputs
from ..sources.formats import input_manifest
from ..sources.scratch import delete, exists, saved


def _key(path: Column | str) -> Column:
    """The partition of a file, however many slashes follow its scheme."""
    return F.sha2(F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/"), 256)


def run_incremental(spark: SparkSession, inputs: str, target: str, compute: Callable[[list[str]], DataFrame]) -> DataFrame:
    """Bring the table at ``target``/rows up to date with the files in ``inputs``; returns (path, reason) of what was stale.

    ``compute`` gives the rows of the named files with a column ``file``, the path that each comes from. They are
    written in a partition for each file, by dynamic overwrite, so the partitions of unchanged
    files are not touched; those of files that are gone, or have no rows any more, are deleted. The manifest is taken
    before the work and kept after it: a run that fails is done again. The paths of stale files, not
    their content, pass through the driver, as those of any reader do.
    """
    rows, state = f"{target.rstrip('/')}/rows", f"{target.rstrip('/')}/manifest"
    now, path = saved(input_manifest(spark, inputs).select("path", "signature"))
    before = spark.read.schema(now.schema).parquet(state) if exists(spark, state) else now.limit(0)
    found = [(r["path"], r["reason"], r["key"]) for r in stale_inputs(before, now).select("path", "reason", _key("path").alias("key")).collect()]
    changed, made = [p for p, reason, _ in found if reason != "missing"], set()
    if changed:
        out = compute(changed).withColumn("input", _key("file"))
        out.repartition("input").write.partitionBy("input").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(rows)
        keys = [k for _, reason, k in found if reason != "missing"]
        made = {k for k in keys if exists(spark, f"{rows}/input={k}")}
        # What a changed file had before counts as made only if this run wrote it.
        made &= {r["input"] for r in out.select("input").distinct().collect()} if made else made
    for _, _, k in found:
        if k not in made:
            delete(spark, f"{rows}/input={k}")
    if found:
        delete(spark, state)
        now.write.parquet(state)
    delete(spark, path)
    return spark.createDataFrame([x[:2] for x in found], "path string, reason string")
