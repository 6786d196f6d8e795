"""Sinks (K1-K3).  Every write is idempotent, so a retried job repeats
exactly: partition overwrite for the ERP table, a versioned keyed upsert for
the rate table, a run-time file name for the export."""

from __future__ import annotations

import datetime as _dt
import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.functions.text import export_name
from ratebook.operators.merge import merge_sources, merge_tagged
from ratebook.operators.quality import GuardError, check_not_null, check_rates, observe_counts
from ratebook.schemas import BPM_KEYS, EXCHANGE_RATE, OUT_RATE
from ratebook.session import staging_path, staging_root

ERP_PARTITIONS = ["job", "RATE_TYPE", "VALID_FROM"]
COPY_BUFFER = 1 << 20          # bytes on their way into a single export file

def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table under the cluster's
    checkpoint folder (``spark.checkpoint.dir``) and read it back.

    One pass over the input (an RDD checkpoint would compute the plan a
    second time to write it), on shared storage (unlike a local checkpoint
    or a cache), so a lost executor never sends the job back to the raw
    history, and later checks read the small staged copy.
    """
    path = staging_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, dict]:
    """``stage`` plus metrics taken during the same write (``observe``):
    always ``rows``, and any named aggregate expressions passed in.  Guards
    read these numbers instead of running their own jobs."""
    observed, obs = observe_counts(df, f"stage-{name}", *[e.alias(k) for k, e in metrics.items()])
    staged = stage(observed, name)
    return staged, dict(obs.get)


def write_erp_rates(erp: DataFrame, path: str, job: str) -> str:
    """K1: the ERP rate rows, partitioned by (job, RATE_TYPE, VALID_FROM).

    Dynamic partition overwrite replaces only the partitions this run
    produces, so a rerun replaces its own rows and a common and a rare run
    of the same month (same VALID_FROM) keep each other's rows.  Rows are
    rebalanced by the partition columns: AQE splits a value that holds many
    rows into tasks of the advisory size and merges small ones.
    """
    (erp.withColumn("job", F.lit(job)).hint("rebalance", *ERP_PARTITIONS)
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*ERP_PARTITIONS)
     .parquet(path))
    return path


def read_erp_rates(spark, path: str) -> DataFrame:
    """Read K1 output back with VALID_FROM kept as text (no type inference)."""
    from pyspark.sql import types as T
    from ratebook.schemas import ERP_COLUMNS
    fields = [T.StructField(c, T.StringType()) for c in ERP_COLUMNS] + \
        [T.StructField("job", T.StringType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def export_rates(erp: DataFrame, out_dir: str, job: str, run_ts: _dt.datetime, one_file: bool = False) -> str:
    """K3: the same rows as K1 as CSV with a header, in a folder named
    ``FinalData__{job}__{yyyyMMdd_HHmm}`` (local time of ``run_ts``, UTC).
    The run time is a parameter, so a retry writes the same export again.

    Rows are ordered by (TO_CURRNCY, FROM_CURR) so exports repeat; the sort
    is a range-partitioned distributed sort, so the export is a set of
    ordered part files rather than one task's worth of data.  With
    ``one_file`` the export is the single file ``<name>.csv`` with one
    header: the same sort and the same tasks write bodies under the
    checkpoint folder, which are then joined in order (``_join_files``).
    """
    # From ISO text: a zone-less literal that no OS or session time zone shifts.
    utc = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    name = erp.sparkSession.range(1).select(export_name(job, utc)).first()[0]
    target = f"{out_dir.rstrip('/')}/{name}"
    ordered = erp.orderBy("TO_CURRNCY", "FROM_CURR", "VALID_FROM")
    if not one_file:
        ordered.write.mode("overwrite").option("header", True).csv(target)
        return target
    bodies = staging_path(erp.sparkSession, "export")
    ordered.write.mode("errorifexists").csv(bodies)
    return _join_files(erp.sparkSession, ",".join(erp.columns) + "\n", bodies, f"{target}.csv")


def _part_order(name: str) -> tuple[int, str]:
    return int(name.split("-")[1]), name           # part-<task>-<job>-<file>.csv; tasks beyond 99999 have more digits


def _join_files(spark, head: str, folder: str, target: str) -> str:
    """``head`` and the part files of ``folder``, in task order, as the one file ``target``.

    The bytes go from the store to the store through a buffer of a fixed
    size; the file is written beside the target and renamed over it, so a
    reader sees the old export or the new one.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, p = _fs(spark, folder)
    parts = sorted((s.getPath().getName() for s in source.listStatus(p) if s.getPath().getName().startswith("part-")), key=_part_order)
    fs, beside = _fs(spark, f"{target}._{os.urandom(6).hex()}")
    out = fs.create(beside, False)
    try:
        out.write(bytearray(head.encode()))
        for name in parts:
            body = source.open(_fs(spark, f"{folder}/{name}")[1])
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(body, out, COPY_BUFFER, False)
            finally:
                body.close()
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    context.rename(fs.makeQualified(beside), fs.makeQualified(_fs(spark, target)[1]), over)
    return target


# The keyed table's layout.  ``data`` holds immutable rows partitioned by
# (run, RateDate); a manifest (a folder of ``versions``) says which run holds
# each RateDate, and version n is the small file ``versions/<n>`` that names
# its manifest.  That file is renamed into place, which fails if it is there
# already: of two writers that start from the same version one wins, and the
# other merges again from the winner's version.
DATA, VERSIONS = "data", "versions"
ORIGIN = "struct<time:timestamp,path:string,pos:int>"        # the quote file a rate comes from, if it is known
DATA_SCHEMA = f"Currency string, Currency2 string, Rate {OUT_RATE.simpleString()}, origin {ORIGIN}, run string, RateDate string"
MANIFEST_SCHEMA = "RateDate string, run string"
COMMIT_TRIES = 20


def _fs(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def rate_versions(spark, path: str) -> list[int]:
    """The committed versions of the keyed table, oldest first."""
    fs, p = _fs(spark, f"{path}/{VERSIONS}")
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.isFile() and s.getPath().getName().isdigit())


def _manifest_path(spark, path: str, version: int) -> str:
    fs, p = _fs(spark, f"{path}/{VERSIONS}/{version}")
    stream = fs.open(p)
    try:
        name = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
    return f"{path}/{VERSIONS}/{name}"


def _manifest(spark, path: str, version: int | None) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(_manifest_path(spark, path, version))


def _commit(spark, path: str, version: int, manifest: str) -> bool:
    """Make ``manifest`` (a folder name) version ``version``; False if another writer has made it."""
    jvm = spark._jvm
    fs, claim = _fs(spark, f"{path}/{VERSIONS}/_claim-{os.urandom(6).hex()}")
    out = fs.create(claim, False)
    out.write(bytearray(manifest.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(claim), fs.makeQualified(_fs(spark, f"{path}/{VERSIONS}/{version}")[1]), plain)
    except Py4JJavaError as e:
        fs.delete(claim, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def _rows_of(spark, path: str, manifest: DataFrame, *pruned) -> DataFrame:
    """The rows a manifest names; ``pruned`` are filters on RateDate that reach the file listing."""
    fs, p = _fs(spark, f"{path}/{DATA}")
    if not fs.exists(p):
        return spark.createDataFrame([], DATA_SCHEMA)
    data = spark.read.schema(DATA_SCHEMA).parquet(f"{path}/{DATA}")
    for condition in pruned:
        data = data.where(condition)
    return data.join(manifest, ["run", "RateDate"], "left_semi")


def upsert_rates(batch: DataFrame, path: str, seq: str = "seq", newest_source: bool = False) -> str:
    """K2: MERGE ``batch`` into the keyed rate table at ``path``, all or nothing.

    Only the dates the batch touches are read (its smallest and largest date
    prune the listing, a semi join does the rest), merged and written as a
    new run; then a manifest that points those dates at the new run is
    committed.  A failure before that leaves readers on the old version.
    Keys, ``Rate`` and ``seq`` must be filled and ``Rate`` a decimal, else
    nothing is written.  Running the same batch twice gives the same table.

    Writers may run side by side: a commit succeeds only on the version it
    was merged from, and one that comes late merges again.  (The store must
    refuse to rename onto a file, as HDFS does.)  Readers need no lock.

    With ``newest_source``, ``seq`` is the (time, path, pos) of the quote
    file behind each row; it is kept with the rate, and a row from an older
    file never replaces one from a newer file, whichever arrives first.
    Without it the batch wins.
    """
    spark = batch.sparkSession
    text = F.col("Rate").cast("string")
    bad = F.count(F.when(text.isNotNull() & text.try_cast(OUT_RATE).isNull(), F.lit(1)))
    order = F.col(seq).cast(ORIGIN) if newest_source else F.col(seq)
    staged_batch, m = stage_observed(
        batch.select(*BPM_KEYS, text.alias("Rate"), order.alias("seq")), "rates-batch", invalid=bad,
        blank=F.count_if(F.array_contains(F.array(*[F.col(c).isNull() for c in (*BPM_KEYS, "Rate", "seq")]), True)),
        first=F.min("RateDate"), last=F.max("RateDate"))
    if not m["rows"]:
        raise GuardError("upsert got no rows")
    if m["blank"]:
        check_not_null(staged_batch, [*BPM_KEYS, "Rate", "seq"], "keyed rates")
    if m["invalid"]:
        check_rates(staged_batch, "Rate")                                  # G4: name samples
    b = staged_batch.select(*BPM_KEYS, F.col("Rate").cast(OUT_RATE).alias("Rate"), "seq",
                            (F.col("seq") if newest_source else F.lit(None)).cast(ORIGIN).alias("origin"))
    dates = b.select("RateDate").distinct()
    for _ in range(COMMIT_TRIES):
        versions = rate_versions(spark, path)
        old = _manifest(spark, path, versions[-1] if versions else None)
        number = (versions or [0])[-1] + 1
        touched = _rows_of(spark, path, old.join(dates, "RateDate", "left_semi"),
                           F.col("RateDate").between(m["first"], m["last"]))
        merged = merge_sources(touched.select(*BPM_KEYS, "Rate", "origin"), b, BPM_KEYS, newest_source)
        run = f"{number}-{os.urandom(4).hex()}"
        (merged.select(*BPM_KEYS, "Rate", "origin").hint("rebalance", "RateDate")
         .write.mode("errorifexists").partitionBy("RateDate").parquet(f"{path}/{DATA}/run={run}"))
        manifest = (old.join(dates, "RateDate", "left_anti")
                    .unionByName(dates.withColumn("run", F.lit(run))))
        manifest.write.mode("errorifexists").parquet(f"{path}/{VERSIONS}/manifest-{run}")
        if _commit(spark, path, number, f"manifest-{run}"):
            return path
    raise RuntimeError(f"other writers committed to {path} {COMMIT_TRIES} times in a row")


def vacuum_rates(spark, path: str, keep: int = 1) -> None:
    """Delete all but the newest ``keep`` versions, and runs and manifests that none of those names.
    Run it while nobody writes: a writer's run has no version yet."""
    versions = rate_versions(spark, path)
    kept = versions[-keep:]
    if not kept:
        return
    named = {r[0] for v in kept for r in _manifest(spark, path, v).select("run").distinct().collect()}
    fs, p = _fs(spark, f"{path}/{DATA}")
    for s in fs.listStatus(p):
        if s.getPath().getName().removeprefix("run=") not in named:
            fs.delete(s.getPath(), True)
    listed = {_manifest_path(spark, path, v).rsplit("/", 1)[1] for v in kept} | {str(v) for v in kept}
    for s in fs.listStatus(_fs(spark, f"{path}/{VERSIONS}")[1]):
        if s.getPath().getName() not in listed:
            fs.delete(s.getPath(), True)


def merge_into_table(batch: DataFrame, table_name: str, seq: str = "seq") -> str:
    """K2 on a catalog table whose format supports row-level MERGE.

    The batch is first reduced to its last row per key (a MERGE source must
    not match a target row twice), then merged on (Currency, Currency2,
    RateDate): matched rows take the batch's ``Rate``, others are inserted.
    Plain Parquet tables do not support MERGE; use ``upsert_rates`` there.
    """
    check_rates(batch, "Rate")
    check_not_null(batch, [*BPM_KEYS, "Rate", seq], "keyed rates")
    src = merge_tagged(batch.select(*BPM_KEYS, "Rate", F.lit(True).alias("is_batch"), F.col(seq).alias("seq")), BPM_KEYS)
    cond = None
    for k in BPM_KEYS:
        c = F.col(f"{table_name}.{k}") == F.col(f"s.{k}")
        cond = c if cond is None else cond & c
    (src.alias("s").mergeInto(table_name, cond)
     .whenMatched().update({"Rate": F.col("s.Rate")})
     .whenNotMatched().insertAll()
     .merge())
    return table_name


def read_rates(spark, path: str, version: int | None = None) -> DataFrame:
    """The keyed table (its newest committed version, or an older one)."""
    versions = rate_versions(spark, path)
    if version is None and versions:
        version = versions[-1]
    if version not in versions:
        raise FileNotFoundError(f"no committed version of the keyed table at {path}")
    rows = _rows_of(spark, path, _manifest(spark, path, version))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in EXCHANGE_RATE.fields])


def drop_staged(spark) -> None:
    """Delete this application's staged tables (call when its outputs are written)."""
    fs, p = _fs(spark, staging_root(spark))
    fs.delete(p, True)
