"""Table writes: partition replace, landing files, rejects, full refresh, schema clone, merges.

Paths live under a lake root on shared storage, never a machine-local folder. Every write replaces
whole partitions, so a retried task or a rerun of the stage yields the same files.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, StringType, StructField, StructType

from daybook.context import RunContext


def partition_path(root: str, table: str, **parts: str) -> str:
    suffix = "/".join(f"{k}={v}" for k, v in parts.items())
    return f"{root.rstrip('/')}/{table}/{suffix}" if suffix else f"{root.rstrip('/')}/{table}"


def replace_partition(df: DataFrame, table_path: str, column: str, value: str, fmt: str = "parquet") -> None:
    """Static overwrite of one partition: the directory is replaced even when ``df`` is empty.

    (A dynamic overwrite would leave yesterday's rows in place on an empty rerun.)
    """
    out = df.drop(column) if column in df.columns else df
    out.write.mode("overwrite").format(fmt).option("compression", "snappy").save(
        f"{table_path.rstrip('/')}/{column}={value}")


WHOLE = ("tinyint", "smallint", "int", "bigint")
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
MISFIT_REASON = "value does not fit the stored column"


def wider_type(stored: DataType, given: DataType) -> DataType:
    """The type that holds every value of both without loss; the stored one if there is none.

    Whole numbers widen to longer ones and to decimals, ``float`` and whole numbers up to ``int`` to ``double``:
    what Parquet readers widen in the older files. What has no such type (text in a number, a double in a
    decimal, a timestamp in a date) is left to be judged value by value.
    """
    a, b = stored.simpleString(), given.simpleString()
    if a == b:
        return stored
    if a in WHOLE and b in WHOLE:
        return max(stored, given, key=lambda t: WHOLE.index(t.simpleString()))

    def digits(t: DataType) -> tuple[int, int] | None:
        return (t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (DIGITS[t.simpleString()], 0) if t.simpleString() in DIGITS else None

    x, y = digits(stored), digits(given)
    if x and y:
        whole, scale = max(x[0], y[0]), max(x[1], y[1])
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else stored
    if a in ("tinyint", "smallint", "int") and b in ("float", "double") or a == "float" and b in ("double", "int"):
        return DoubleType()
    return stored


def fit_types(df: DataFrame, stored: StructType) -> tuple[DataFrame, StructType]:
    """``df`` with the columns of ``stored`` in types that hold the old and the new values, plus ``_misfit``, the
    columns whose value fits in no such type (null: none): it cannot be cast, or not back to what it was.
    The second result is ``stored`` with its types widened."""
    fields, casts, misfits = [], [], []
    for f in stored.fields:
        if f.name not in df.columns:
            fields.append(f)
            casts.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        given, c = df.schema[f.name].dataType, F.col(f"`{f.name}`")
        wide = wider_type(f.dataType, given)
        fields.append(StructField(f.name, wide))
        if wide == given:
            casts.append(c.alias(f.name))
            continue
        typed = c.try_cast(wide)
        casts.append(typed.alias(f.name))
        if wide == f.dataType:  # nothing was widened: each value has to show that it fits
            lost = typed.isNull() if isinstance(given, StringType) else ~F.coalesce(typed.try_cast(given) == c, F.lit(False))
            misfits.append(F.when(c.isNotNull() & lost, F.lit(f.name)))
    misfit = F.nullif(F.concat_ws(", ", *misfits), F.lit("")) if misfits else F.lit(None).cast("string")
    return df.select(*casts, misfit.alias("_misfit"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_given")), StructType(fields)


def _change_types(spark: SparkSession, table: str, schema: StructType) -> None:
    """New types of a catalog table's columns; Parquet readers widen what older files hold."""
    state = spark._jsparkSession.sessionState()
    new = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json())
    state.catalog().alterTableDataSchema(state.sqlParser().parseTableIdentifier(table), new)
    spark.catalog.refreshTable(table)


def insert_overwrite_partition(spark: SparkSession, df: DataFrame, table: str, column: str, value: str,
                               misfits: Callable[[DataFrame], None] | None = None) -> None:
    """Catalog form of the same replace: ``INSERT OVERWRITE t PARTITION (c = 'v')``, columns by name.

    A column that the table does not have yet is added to it first (older partitions read NULL); one
    that the frame lacks is written as NULL. Where types differ the stored one is widened if that loses nothing
    (``wider_type``). Rows with a value that fits in no such type are not stored: they go to ``misfits``, as they
    came and with ``reject_reason``; without it such a row fails the write. No value becomes NULL on its way.
    """
    known = {f.name: f.dataType for f in spark.table(table).schema.fields}
    new = [f for f in df.schema.fields if f.name not in known and f.name != column]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    stored = StructType([f for f in spark.table(table).schema.fields if f.name != column])
    typed, wide = fit_types(df.drop(column), stored)
    if [f.dataType for f in wide.fields] != [f.dataType for f in stored.fields]:
        _change_types(spark, table, wide)
    if misfits is not None and "_misfit" in typed.columns and any(_judged(df, f) for f in stored.fields):
        bad = typed.filter(F.col("_misfit").isNotNull())
        misfits(bad.select("_given.*", F.concat(F.lit(f"{MISFIT_REASON}: "), F.col("_misfit")).alias("reject_reason")))
        typed = typed.filter(F.col("_misfit").isNull())
    else:
        fails = F.raise_error(F.concat(F.lit(f"{table}: {MISFIT_REASON}: "), F.col("_misfit"))).cast("boolean")
        typed = typed.filter(F.when(F.col("_misfit").isNotNull(), fails).otherwise(F.lit(True)))
    out = typed.select(*[F.col(f"`{f.name}`") for f in wide.fields])
    view = f"_src_{uuid.uuid4().hex[:8]}"
    out.createOrReplaceTempView(view)
    try:
        cols = ", ".join(f"`{f.name}`" for f in wide.fields)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({column} = '{value}') SELECT {cols} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def _judged(df: DataFrame, stored: StructField) -> bool:
    """Whether the column's values are judged one by one."""
    if stored.name not in df.columns or df.schema[stored.name].dataType == stored.dataType:
        return False
    return wider_type(stored.dataType, df.schema[stored.name].dataType) == stored.dataType


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def remove_folder(spark: SparkSession, path: str) -> None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def listed(spark: SparkSession, path: str, folders: bool) -> list[str]:
    """Names of the folders, or of the data files, in a folder; none where there is no such folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.listStatus(root) if fs.exists(root) else []
    names = [s.getPath().getName() for s in found if s.isDirectory() == folders]
    return names if folders else [n for n in names if n[0] not in "_."]


# NULL is written as an explicit marker so that an empty string survives the round trip as ''
# (with the default options both come back as NULL).
CSV_NULL = "\\N"
# Line breaks inside a value are written as backslash escapes, so one record is one line and a large
# file is read by many tasks. Order matters: the escape character first on write, last on read.
CSV_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))


def write_landing_csv(df: DataFrame, path: str) -> None:
    """Landing CSV: header, quoted as needed, one line per record (``sources.files.read_landed_csv``)."""
    def escaped(name: str) -> Column:
        c = F.col(name)
        for raw, code in CSV_ESCAPES:
            c = F.replace(c, F.lit(raw), F.lit(code))
        return c.alias(name)

    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    out = df.select(*[escaped(c) if c in text else F.col(c) for c in df.columns])
    (out.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", CSV_NULL)
     .option("emptyValue", '""').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_landing_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)


def write_rejects(rejected: DataFrame, root: str, table: str, ctx: RunContext, stamp: bool = True) -> int:
    """Rejects of one run, kept only when there are any; returns their number. ``stamp`` adds
    ``rejected_at`` (relational tables have it, the ratings feed has not).

    The count comes from an ``Observation`` on the write itself (one job, not count-then-write);
    an empty result's folder is removed afterwards.
    """
    obs = Observation(f"rejects_{table}")
    out = rejected.withColumn("rejected_at", ctx.now()) if stamp else rejected
    out = out.observe(obs, F.count(F.lit(1)).alias("n"))
    path = partition_path(root, f"rejected_zone/{table}", processing_date=ctx.processing_date, run_id=ctx.run_id)
    out.write.mode("overwrite").parquet(path)
    n = int(obs.get["n"])
    if n == 0:
        remove_folder(rejected.sparkSession, path)
    return n


def schema_clone(df: DataFrame) -> DataFrame:
    """An empty frame with the same columns and types (``CREATE TABLE AS SELECT ... WHERE 1 = 0``)."""
    return df.filter(F.lit(False))


class PartitionedTable:
    """A mutable catalog table of plain Parquet files, partitioned by one column.

    A write goes to a folder of its own, ``version=<time>-<id>``; when its job has committed (``_SUCCESS``)
    the catalog is told, partition by partition, to read it (``ALTER TABLE ... SET LOCATION``), and the
    folders that nothing reads any more are removed. Until then every stored row stays where it was: a run
    that dies while it writes changes nothing, and one that dies after its job committed is finished by the
    next ``merge`` or ``replace``, which first switches what is still to be switched. A catalog that
    does not know the table (the in-memory one of a new session) is told the newest committed version of each
    partition. One writer at a time (the single active run).

    The partition column is one of the table's columns or, with ``by``, an expression over them that
    only the files' layout shows (a month, a bucket of the key). ``of_keys`` says that its value
    depends on the merge keys only, so that an updated row cannot change partition.

    ``zone``: columns whose values the merge keys determine (the keys themselves, if none is named). Next to a
    version lies a summary of its partitions: the least and largest of these, and Bloom bitmaps of the keys. A
    merge asks it which partitions can hold a key of the source and looks for the keys in those alone (for a
    source so large that asking the filters is more work than reading the keys, the ranges alone decide).

    ``derived``: columns that are computed one to one from others (null where one of these is null), as (these,
    expression). A write moves the others and computes them where the rows end up, and a merge on such a key
    compares the columns that it is computed from: a key of 32 hex digits would be most of what is shuffled.
    Frames to be written may lack them.
    """

    FILES, SMALL = 8, 16_000_000  # files, and bytes of one on average, from which a merge gathers a partition's rows anew
    BITS, HASHES, BITMAP = 16, 4, 32_768  # bits for each key, positions of a key, bits of one bitmap

    def __init__(self, spark: SparkSession, path: str, schema: StructType, partition: str, by: Column | None = None,
                 of_keys: bool = False, name: str | None = None, zone: list[str] | None = None,
                 derived: dict[str, tuple[list[str], Column]] | None = None):
        self.spark, self.path, self.partition, self.by, self.of_keys = spark, path.rstrip("/"), partition, by, of_keys
        self.name = name or f"daybook_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"
        self.zone = zone
        self.derived = {c: d for c, d in (derived or {}).items() if c in schema.names}
        self.columns = [f.name for f in schema.fields]
        part = [] if by is None else [StructField(partition, StringType())]
        self.schema = StructType([StructField(f.name, f.dataType) for f in schema.fields] + part)
        self.searched: dict[str, int] = {}  # of the last merge: partitions, those that may hold a key, keys read

    # --- the catalog ---

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name) or path_exists(self.spark, self.path)

    def _open(self) -> None:
        """The catalog knows the table, its columns and the newest committed version of its partitions."""
        if not self.spark.catalog.tableExists(self.name):
            data = [f for f in self.schema.fields if f.name != self.partition]
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*data, self.schema[self.partition]])
            if "." in self.name:
                self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.name.split('.')[0]}")
            self.spark.sql(f"CREATE TABLE {self.name} ({cols}) USING parquet PARTITIONED BY (`{self.partition}`) LOCATION {_literal(self.path)}")
        known = set(self.spark.table(self.name).columns)
        new = [f for f in self.schema.fields if f.name not in known]
        if new:
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
        self._switch(self._committed())

    def _folders(self, path: str) -> list[str]:
        return listed(self.spark, path, True)

    def _committed(self) -> dict[str, str]:
        """Partition folder name -> where its newest committed version lies. A table has few versions at a time:
        those that its partitions use."""
        mark, here = f"{self.partition}=", self._folders(self.path)
        found = {f: f"{self.path}/{f}" for f in here if f.startswith(mark)}  # files that were there before
        for version in sorted(f for f in here if f.startswith("version=")):
            if path_exists(self.spark, f"{self.path}/{version}/_SUCCESS"):
                found.update({f: f"{self.path}/{version}/{f}" for f in self._folders(f"{self.path}/{version}") if f.startswith(mark)})
        return found

    def _current(self) -> dict[str, str]:
        """Partition folder name -> the folder that the catalog reads."""
        state = self.spark._jsparkSession.sessionState()
        listed = state.catalog().listPartitions(state.sqlParser().parseTableIdentifier(self.name), self.spark._jvm.scala.Option.empty())
        jvm = self.spark._jvm
        path_of, named = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        out, each = {}, listed.iterator()
        while each.hasNext():
            p = each.next()
            out[named(self.partition, p.spec().apply(self.partition))] = path_of(p.location()).toString()
        return out

    def _spec(self, folder: str) -> str:
        value = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder.split("=", 1)[1])
        return f"`{self.partition}` = {'null' if value == '__HIVE_DEFAULT_PARTITION__' else _literal(value)}"

    def _switch(self, places: dict[str, str]) -> None:
        """Make the catalog read the partitions at these places; those it reads elsewhere stay readable until
        they are switched."""
        current = self._current()
        for folder in [f for f in places if f in current and _place(current[f]) != _place(places[f])]:
            self.spark.sql(f"ALTER TABLE {self.name} PARTITION ({self._spec(folder)}) SET LOCATION {_literal(places[folder])}")
        new = [f for f in places if f not in current]
        for lo in range(0, len(new), 100):
            added = " ".join(f"PARTITION ({self._spec(f)}) LOCATION {_literal(places[f])}" for f in new[lo:lo + 100])
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {added}")

    def _forget(self, folders: set[str]) -> None:
        """Partitions without rows leave the catalog."""
        gone = sorted(folders & set(self._current()))
        for lo in range(0, len(gone), 100):
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {', '.join(f'PARTITION ({self._spec(f)})' for f in gone[lo:lo + 100])}")

    def vacuum(self) -> None:
        """Remove the folders that no partition reads: of replaced versions and of runs that died."""
        used = {_place(p) for p in self._current().values()}
        for folder in self._folders(self.path):
            place = f"{self.path}/{folder}"
            if folder.startswith("version="):
                inside = [f for f in self._folders(place) if f.startswith(f"{self.partition}=")]
                stale = [f for f in inside if _place(f"{place}/{f}") not in used]
                doomed = [place] if len(stale) == len(inside) else [f"{place}/{f}" for f in stale]
            else:
                doomed = [place] if folder.startswith(f"{self.partition}=") and _place(place) not in used else []
            for d in doomed:
                remove_folder(self.spark, d)

    # --- reading and writing ---

    def _stored(self) -> DataFrame:
        return self.spark.table(self.name)

    def read(self) -> DataFrame | None:
        if not self.exists():
            return None
        if not self.spark.catalog.tableExists(self.name) or not set(self.schema.names) <= set(self._stored().columns):
            self._open()  # also for columns that are new
        return self._stored().select(*self.columns)

    def read_partitions(self, values: list) -> DataFrame:
        """The rows of these partitions alone."""
        self._open()
        return self._stored().filter(self._inside(values)).select(*self.columns)

    def replace_partitions(self, df: DataFrame, values: list, dealt: bool = False) -> None:
        """Replace these partitions by the rows of ``df``, which are all of them; one without rows goes.
        ``dealt``: a partition's rows lie in few tasks already."""
        self._open()
        if not values:
            return
        places = self._write(self._placed(df) if dealt else self._gathered(self._placed(df)), None)
        self._switch(places)
        self._forget(self._names(values) - set(places))
        self.vacuum()

    def _names(self, values: list) -> set[str]:
        utils = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        return {utils.getPartitionPathString(self.partition, None if v is None else str(v)) for v in values}

    def _placed(self, df: DataFrame) -> DataFrame:
        df = df.select(*[c for c in self.columns if c in df.columns or c not in self.derived])
        return df if self.by is None else df.withColumn(self.partition, self.by.cast("string"))

    def _gathered(self, df: DataFrame) -> DataFrame:
        """The rebalance hint gathers a partition's rows (few files), and AQE splits a large one. Text columns go first:
        rows that follow one another are alike in most of the others, which then are packed as one run."""
        df = df.drop(*self.derived)
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
        return df.select(*text, *[c for c in df.columns if c not in text]).hint("rebalance", self.partition)

    def _scattered(self, values: list) -> list:
        """Those of these partitions that lie in many small files."""
        out, places, jvm = [], self._current(), self.spark._jvm
        for v in values:
            place = places.get(next(iter(self._names([v]))))
            if place:
                path = jvm.org.apache.hadoop.fs.Path(place)
                found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
                sizes = [s.getLen() for s in found if s.getPath().getName()[0] not in "_."]
                if len(sizes) > self.FILES and sum(sizes) < len(sizes) * self.SMALL:
                    out.append(v)
        return out

    def _write(self, df: DataFrame, keys: list[str] | None) -> dict[str, str]:
        """Write the partitions of ``df``, whose rows are gathered, to a new version; where they are."""
        version = f"{self.path}/version={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        whole = df.withColumns({c: value.cast(self.schema[c].dataType) for c, (_, value) in self.derived.items()})
        whole.select(*self.schema.names).write.partitionBy(self.partition).option("compression", "zstd").parquet(version)
        if keys:
            self._summarise(version, keys)
        return {f: f"{version}/{f}" for f in self._folders(version) if f.startswith(f"{self.partition}=")}

    def replace(self, df: DataFrame, keys: list[str] | None = None, dealt: bool = False) -> None:
        """Full refresh; ``keys``: of later merges, to summarise them now; ``dealt``: see ``replace_partitions``."""
        self._open()
        places = self._write(self._placed(df) if dealt else self._gathered(self._placed(df)), None if self.of_keys or not keys else self._compared(keys))
        self._switch(places)
        self._forget(set(self._current()) - set(places))
        self.vacuum()

    def merge(self, source: DataFrame, keys: list[str], update_when=None, check_unique: bool = True) -> list:
        """MERGE ``source``; returns the partition values that were rewritten.

        ``source`` is read several times: give a written or persisted frame. Touched partitions are
        the source's and those that hold a row whose key occurs in the source (looked for in the partitions that
        may hold one and are not the source's, by their keys alone). Their distinct values reach the driver: a table
        has as many as its layout has folders, never as many as rows.
        """
        from daybook.operators.prefilter import split_by_key
        from daybook.operators.upsert import upsert

        self._open()
        self.vacuum()  # what a run that died left behind
        source, stored, p, keys = self._placed(source), self._stored().select(*self.schema.names), self.partition, self._compared(keys)
        values = [r[0] for r in source.select(p).distinct().collect()]
        current = set(self._current())
        self.searched, likely = {"partitions": len(current), "likely": 0, "keys": 0}, []
        # the source's own partitions are rewritten anyway
        if not self.of_keys and (others := current - self._names(values)):
            likely = self._may_hold(source, keys, others)
        if likely:
            obs = Observation(f"keys_{uuid.uuid4().hex[:8]}")
            asked = stored.filter(self._inside(likely)).select(p, *[k for k in keys if k != p]).observe(obs, F.count(F.lit(1)).alias("n"))
            held = asked.join(source.select(*keys).distinct(), list(keys), "left_semi").select(p)
            values = [r[0] for r in source.select(p).union(held).distinct().collect()]
            self.searched |= {"likely": len(likely), "keys": int(obs.get["n"])}
        if not values:
            return []
        # only stored rows that may match are moved to the source's; derived columns are computed anew
        stored, source = stored.filter(self._inside(values)).drop(*self.derived), source.drop(*self.derived)
        likely, rest = split_by_key(stored, source, keys, source.dropna(subset=keys).count())
        # rows that stay lie by partition already: only those of partitions in many small files are gathered anew
        many = F.coalesce(self._inside(self._scattered(values)), F.lit(False))
        changed = upsert(likely, source, keys, update_when, check_unique).unionByName(rest.filter(many))
        merged = self._gathered(changed).unionByName(rest.filter(~many))
        places = self._write(merged, None if self.of_keys else keys)
        self._switch(places)
        self._forget(self._names(values) - set(places))  # every row of the partition has moved to another one
        self.vacuum()
        return values

    def _inside(self, values: list) -> Column:
        inside = F.col(self.partition).isin([v for v in values if v is not None])
        return F.coalesce(inside, F.lit(False)) | F.col(self.partition).isNull() if None in values else inside

    def _compared(self, keys: list[str]) -> list[str]:
        """The columns that a merge on these keys compares."""
        return list(dict.fromkeys(c for k in keys for c in (self.derived[k][0] if k in self.derived else [k])))

    # --- which partitions can hold a key ---

    def _blooms(self, keys: list[str]) -> str:
        """Folder of the filters; those of a derived key are filters of other columns than the key's own would be."""
        return "_blooms" if not self.derived else f"_blooms-{'-'.join(keys)}"

    def _positions(self, keys: list[str], bits: Column) -> Column:
        return F.array(*[F.pmod(F.xxhash64(F.lit(n), *keys), bits) for n in range(self.HASHES)])

    def _summarise(self, version: str, keys: list[str]) -> None:
        """Per partition of a version: its number of rows with all keys, the range of the zone columns and, in
        ``BITMAP`` bits each, a Bloom filter of the keys of ``BITS`` bits a key."""
        p, zone = self.partition, self.zone or keys
        rows = self.spark.read.schema(self.schema).parquet(version).dropna(subset=list(keys))
        ranges = [F.struct(F.min(z).alias("low"), F.max(z).alias("high")).alias(f"zone_{n}") for n, z in enumerate(zone)]
        size = F.count(F.lit(1)) * self.BITS / self.BITMAP
        parts = replace_table(rows.groupBy(p).agg(F.count(F.lit(1)).alias("keys"), F.ceil(size).cast("long").alias("bitmaps"), *ranges), f"{version}/_zones")
        bits = F.col("bitmaps") * F.lit(self.BITMAP)
        # one row for each partition: as many as the layout has folders
        at = rows.select(p, *keys).join(F.broadcast(parts.select(F.col(p).alias("_p"), "bitmaps")), F.col(p).eqNullSafe(F.col("_p")))
        at = at.select(p, "bitmaps", F.explode(self._positions(keys, bits)).alias("at"))
        at.groupBy(p, "bitmaps", F.expr(f"at div {self.BITMAP}").alias("bitmap")).agg(
            F.bitmap_construct_agg(F.col("at") % self.BITMAP).alias("bits")).write.parquet(f"{version}/{self._blooms(keys)}")

    def _may_hold(self, source: DataFrame, keys: list[str], others: set[str]) -> list:
        """Those of these partitions that can hold a key of the source: all without a summary, and those whose ranges
        and Bloom filter do not rule every key out."""
        p, zone, jvm = self.partition, self.zone or keys, self.spark._jvm
        roots: dict[str, list[str]] = {}
        for folder, place in self._current().items():
            if folder not in others:
                continue
            roots.setdefault(place.rstrip("/").rsplit("/", 1)[0], []).append(folder)
        versions = {root: folders for root, folders in roots.items() if path_exists(self.spark, f"{root}/{self._blooms(keys)}/_SUCCESS")}
        unknown = [f for root, folders in roots.items() if root not in versions for f in folders]
        utils = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils

        def value(folder: str):
            v = utils.unescapePathName(folder.split("=", 1)[1])
            return None if v == "__HIVE_DEFAULT_PARTITION__" else v

        def of(name: str) -> DataFrame:
            """The summaries of the partitions that are read, each from its own version."""
            found = None
            for root, folders in versions.items():
                df = self.spark.read.parquet(f"{root}/{name}")
                used = [value(f) for f in folders]
                here = F.col(p).cast("string").isin([v for v in used if v is not None])
                df = df.filter(F.coalesce(here, F.lit(False)) | F.col(p).isNull() if None in used else here)
                found = df if found is None else found.unionByName(df)
            return found

        typed = self.schema[p].dataType
        likely = [r[0] for r in self.spark.createDataFrame([(value(f),) for f in unknown], "v string").select(F.col("v").cast(typed)).collect()] if unknown else []
        if versions:
            keyed = source.dropna(subset=list(keys))
            span = keyed.agg(*[F.struct(F.min(z).alias("low"), F.max(z).alias("high")).alias(f"_{i}") for i, z in enumerate(zone)])
            # a single row against one row for each partition
            near = of("_zones").join(F.broadcast(span))
            for i in range(len(zone)):
                near = near.filter((F.col(f"_{i}.low") <= F.col(f"zone_{i}.high")) & (F.col(f"_{i}.high") >= F.col(f"zone_{i}.low")))
            near = near.select(p, "bitmaps", "keys", *[f"zone_{i}" for i in range(len(zone))])
            here = near.select(p, "bitmaps", "keys").collect()  # one row for each partition at most
            sizes = sorted({r["bitmaps"] for r in here})
            asked = keyed.select(*dict.fromkeys([*keys, *zone])).distinct()
            # asking every filter for every key has to be less work than reading the keys themselves
            if keyed.count() * len(here) * self.HASHES >= sum(r["keys"] for r in here):
                likely += [r[p] for r in here]
            else:
                # each key at its positions in filters of every size that occurs; a partition may hold it if all are set
                size = F.explode(F.array(*[F.lit(x).cast("long") for x in sizes])).alias("bitmaps")
                asked = asked.select(F.xxhash64(*keys).alias("key"), *[F.col(z).alias(f"_{i}") for i, z in enumerate(zone)],
                                     *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], size)
                at = asked.withColumn("at", F.explode(self._positions([f"_k{i}" for i in range(len(keys))], F.col("bitmaps") * F.lit(self.BITMAP))))
                at = at.withColumn("bitmap", F.expr(f"at div {self.BITMAP}"))
                blooms = of(self._blooms(keys)).join(F.broadcast(near.withColumnRenamed("bitmaps", "_n").withColumnRenamed(p, "_p")), F.col(p).eqNullSafe(F.col("_p")))
                hit = at.join(blooms, ["bitmaps", "bitmap"])
                for i in range(len(zone)):
                    hit = hit.filter(F.col(f"_{i}").between(F.col(f"zone_{i}.low"), F.col(f"zone_{i}.high")))
                byte = F.expr(f"conv(hex(substring(bits, cast((at % {self.BITMAP}) div 8 as int) + 1, 1)), 16, 10)").cast("int")
                hit = hit.filter(F.getbit(byte, (F.col("at") % 8).cast("int")) == 1)
                held = hit.groupBy(p, "key").agg(F.count_distinct("at").alias("n"), F.first("bitmaps").alias("bitmaps"))
                # positions of a key may coincide: as many distinct ones as it has are to be set
                wanted = at.groupBy("key", "bitmaps").agg(F.count_distinct("at").alias("wanted"))
                held = held.join(wanted, ["key", "bitmaps"]).filter(F.col("n") == F.col("wanted"))
                likely += [r[0] for r in held.select(F.col(p).cast(typed)).distinct().collect()]
        return likely


def _literal(text: str) -> str:
    quoted = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{quoted}'"


def _place(path: str) -> str:
    """One spelling of a folder's path (``file:/x``, ``file:///x`` and ``/x`` are the same)."""
    scheme, _, rest = path.partition(":") if re.match(r"[a-z0-9]+:", path) else ("", "", path)
    return f"{'' if scheme == 'file' else scheme}/{rest.strip('/')}"


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Full refresh of an unpartitioned table (small models, marts, reports); returns it as written."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
