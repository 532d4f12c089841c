"""A warehouse that is published version by version: repeatable appends, checked content, enforced keys.

Under the root folder::

    data/<table>/version=<n>/batch_id=<id>/   the rows a load wrote, bucketed and sorted by the table's key
    versions/<n>.json                         the versions, batches and contents that make up version n

A load writes its batch as a new version of every table, checks it, and only then adds the
version file, by a rename that fails if another load was first. Readers follow the highest
version file, so they see all tables of a load or none, and what a broken load left is
overwritten by the next one. A batch that is already in the versions file is not written again, and
nothing stored is read to find that out.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.star import StarTables
from ..schemas import FOREIGN_KEYS, PRIMARY_KEYS, STAR_SCHEMAS, STAR_TABLES

_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
FACT = "fact_orders"


class ConstraintError(ValueError):
    """A load that was refused; ``violations`` has (table, constraint, rows)."""

    def __init__(self, violations: list[tuple[str, str, int]]):
        super().__init__("; ".join(f"{t}: {c} broken by {n} rows" for t, c, n in violations))
        self.violations = violations


class ContentError(ValueError):
    """What was read back is not what was written."""


class ConflictError(RuntimeError):
    """Another load was published since this one began."""


@dataclass(frozen=True)
class Content:
    """Rows of a table, and a digest of them as a multiset: sum and XOR of the rows' hashes."""

    rows: int
    sum: str
    xor: str


@dataclass(frozen=True)
class Batch:
    version: int
    batch_id: str
    tables: dict[str, Content]
    violations: list[tuple[str, str, int]] = field(default_factory=list)


def _content_columns(name: str) -> dict:
    row = F.xxhash64(*STAR_SCHEMAS[name].names)
    return {"rows": F.count("*"), "sum": F.sum(row.cast("decimal(20,0)")).cast("string"), "xor": F.bit_xor(row).cast("string")}


def _as_content(values: Mapping) -> Content:
    return Content(values["rows"], values["sum"] or "0", values["xor"] or "0")


def content(df: DataFrame, name: str) -> Content:
    """Digest of a star table; the order and the files of its rows don't matter. One aggregate, no shuffle of rows."""
    typed = df.select(*(F.col(f.name).cast(f.dataType) for f in STAR_SCHEMAS[name]))
    return _as_content(typed.agg(*(c.alias(n) for n, c in _content_columns(name).items())).first().asDict())


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class VersionFiles:
    """Numbered text files of a folder on any Hadoop file system; a number is given out once."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._gateway, self._folder = spark._jvm, spark.sparkContext._gateway, folder
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/{name}")

    def _fs(self):
        return self._path("x").getFileSystem(self._conf)

    def last(self) -> int:
        """The highest number, 0 without any."""
        folder = self._jvm.org.apache.hadoop.fs.Path(self._folder)
        fs = folder.getFileSystem(self._conf)
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def read(self, number: int) -> str:
        stream = self._fs().open(self._path(f"{number:08d}.json"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, folder: str) -> None:
        path = self._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self._conf).delete(path, True)

    def add(self, number: int, text: str) -> None:
        """Write beside, then rename: the file is there whole or not at all. Fails if the number is taken."""
        target, beside = self._path(f"{number:08d}.json"), self._path(f"_{number:08d}-{hashlib.sha256(text.encode()).hexdigest()[:12]}")
        stream = self._fs().create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)  # none: never overwrite
        try:
            context.rename(beside, target, options)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
                raise ConflictError(f"version {number} was published by another load") from e
            raise


class Warehouse:
    """The star tables under a root folder; ``buckets`` is fixed by the first load (default: shuffle.partitions)."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self._versions = VersionFiles(spark, f"{self.root}/versions")
        self._wanted_buckets = buckets

    # --- reading ---

    def _manifest(self, version: int | None = None) -> dict:
        number = self._versions.last() if version is None else version
        if not number:
            return {"version": 0, "buckets": self._wanted_buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions")), "batches": []}
        return json.loads(self._versions.read(number))

    @staticmethod
    def _batches(manifest: dict) -> list[Batch]:
        return [
            Batch(b["version"], b["batch_id"], {t: Content(**c) for t, c in b["tables"].items()}, [tuple(v) for v in b["violations"]])
            for b in manifest["batches"]
        ]

    def version(self) -> int:
        return self._versions.last()

    def batches(self, version: int | None = None) -> list[Batch]:
        """The ledger: what the published version is made of."""
        return self._batches(self._manifest(version))

    def _table(self, name: str, batches: list[Batch], buckets: int) -> DataFrame:
        """Rows of some batches. A table of the session's catalog, so that Spark knows the buckets."""
        table = self._name(name)
        schema, key = STAR_SCHEMAS[name], PRIMARY_KEYS[name]
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}, version INT, batch_id STRING) USING parquet "
            f"PARTITIONED BY (version, batch_id) CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS "
            f"LOCATION '{self.root}/data/{name}'"
        )
        for start in range(0, len(batches), 500):
            parts = " ".join(f"PARTITION (version={b.version}, batch_id='{b.batch_id}')" for b in batches[start : start + 500])
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
        self.spark.catalog.refreshTable(table)
        # Both names of a partition: a broken load may have left another batch under the same version.
        wanted = [f"{b.version}/{b.batch_id}" for b in batches]
        found = self.spark.table(table)
        return found.where(F.concat_ws("/", F.col("version").cast("string"), "batch_id").isin(wanted)) if wanted else found.where("false")

    def _name(self, name: str) -> str:
        return f"star_{hashlib.sha256(self.root.encode()).hexdigest()[:16]}_{name}"

    def table(self, name: str, version: int | None = None) -> DataFrame:
        manifest = self._manifest(version)
        return self._table(name, self._batches(manifest), manifest["buckets"]).select(*STAR_SCHEMAS[name].names)

    def read(self, version: int | None = None, unique_keys: bool = False) -> StarTables:
        """All tables of one published version."""
        number = self._versions.last() if version is None else version
        if not number:
            raise FileNotFoundError(f"nothing is published under {self.root}")
        return StarTables({name: self.table(name, number) for name in STAR_TABLES}, unique_keys)

    # --- loading ---

    def load(self, star: Mapping[str, DataFrame], batch_id: str, mode: str = "full", skip_known: bool = False, constraints: str = "refuse") -> Batch:
        """Write the tables as a batch and publish them as the next version.

        ``full`` replaces what is published, ``incremental`` adds to it. An incremental batch
        whose id the published version has returns its ledger entry and does nothing.
        ``skip_known`` leaves out rows whose key is stored. ``constraints``: NOT NULL columns,
        unique keys (in the batch and against what is stored) and foreign keys; ``refuse``
        raises and publishes nothing, ``report`` notes the violations, ``off`` looks at none.
        """
        if mode not in ("full", "incremental"):
            raise ValueError(f"unknown load mode {mode!r}, use 'full' or 'incremental'")
        if constraints not in ("refuse", "report", "off"):
            raise ValueError(f"unknown constraints {constraints!r}, use 'refuse', 'report' or 'off'")
        if not batch_id or not all(c.isalnum() or c in "-_." for c in batch_id):
            raise ValueError(f"a batch id is letters, digits and -_. only, not {batch_id!r}")
        manifest = self._manifest()
        stored = self._batches(manifest) if mode == "incremental" else []
        known = next((b for b in stored if b.batch_id == batch_id), None)
        if known:
            return known
        version, buckets = manifest["version"] + 1, manifest["buckets"]
        found: dict[str, Content] = {}
        broken: list[tuple[str, str, int]] = []
        here = Batch(version, batch_id, {})
        for name in STAR_TABLES:
            before = self._table(name, stored, buckets)
            rows = star[name].select(*(F.col(f.name).cast(f.dataType) for f in STAR_SCHEMAS[name]))
            if skip_known and stored:
                rows = rows.join(before.select(PRIMARY_KEYS[name]), PRIMARY_KEYS[name], "left_anti").select(*rows.columns)
            found[name], seen = self._write(name, rows, here, buckets)
            broken += seen
            staged = self._table(name, [here], buckets)
            back = content(staged, name)
            if back != found[name]:
                raise ContentError(f"{name}: {found[name]} was written, {back} read back")
            key = PRIMARY_KEYS[name]
            if constraints != "off":
                broken.append((name, f"unique: {key}", self._repeated(staged, key)))
            if constraints != "off" and stored and not skip_known:
                again = staged.where(F.col(key).isNotNull()).join(before.select(key), key, "left_semi").count()
                broken.append((name, f"unique in the warehouse: {key}", again))
        if constraints != "off":
            broken += self._orphans(here, stored, buckets)
        broken = [b for b in broken if b[2]] if constraints != "off" else []
        if broken and constraints == "refuse":
            raise ConstraintError(broken)
        batch = Batch(version, batch_id, found, broken)
        text = json.dumps({"version": version, "buckets": buckets, "batches": [asdict(b) for b in [*stored, batch]]})
        self._versions.add(version, text)
        return batch

    def _write(self, name: str, rows: DataFrame, batch: Batch, buckets: int) -> tuple[Content, list[tuple[str, str, int]]]:
        """One job: the rows in their buckets, sorted once; content and broken NOT NULL columns are observed on the way."""
        key, schema = PRIMARY_KEYS[name], STAR_SCHEMAS[name]
        required = [f.name for f in schema if not f.nullable]
        seen = Observation()
        checks = {f"not null: {c}": F.count_if(F.col(c).isNull()) for c in required}
        metrics = {**_content_columns(name), **checks}
        observed = rows.repartition(buckets, key).observe(seen, *(c.alias(n) for n, c in metrics.items()))
        out = observed.withColumns({"version": F.lit(batch.version), "batch_id": F.lit(batch.batch_id)})
        self._table(name, [], buckets)
        self._versions.delete(f"{self.root}/data/{name}/version={batch.version}/batch_id={batch.batch_id}")  # of a broken load
        with _setting(self.spark, _OVERWRITE, "dynamic"):
            out.write.mode("overwrite").insertInto(self._name(name))
        values = seen.get
        return _as_content(values), [(name, c, values[c]) for c in checks]

    @staticmethod
    def _repeated(staged: DataFrame, key: str) -> int:
        """Rows beyond the first of each key. Reads the key column of the written buckets, which hold a key whole: no shuffle of rows."""
        counts = staged.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        return counts.where("n > 1").agg(F.sum(F.col("n") - 1)).first()[0] or 0

    def _orphans(self, batch: Batch, stored: list[Batch], buckets: int) -> list[tuple[str, str, int]]:
        """Rows of the batch's fact whose key no dimension row has, in the batch or stored: the fact's keys are counted first."""
        fact, out = self._table(FACT, [batch], buckets), []
        for column, dim in FOREIGN_KEYS.items():
            counts = fact.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
            keys = self._table(dim, [*stored, batch], buckets).select(F.col(PRIMARY_KEYS[dim]).alias(column))
            n = counts.join(keys, column, "left_anti").agg(F.sum("n")).first()[0]
            out.append((FACT, f"foreign: {column} in {dim}", n or 0))
        return out


def load_published(star: Mapping[str, DataFrame], mode: str, warehouse: str, batch_id: str, **options) -> dict[str, DataFrame]:
    """Load through a :class:`Warehouse`; returns the published tables."""
    house = Warehouse(next(iter(star.values())).sparkSession, warehouse, options.pop("buckets", None))
    house.load(star, batch_id, mode, **options)
    return house.read()


def version_rows(batches: list[Batch], spark: SparkSession) -> DataFrame:
    """The ledger as rows: version, batch_id, table_name, row_count, digest. One row a batch and table."""
    rows = [(b.version, b.batch_id, t, c.rows, f"{c.sum}:{c.xor}") for b in batches for t, c in b.tables.items()]
    return spark.createDataFrame(rows, "version int, batch_id string, table_name string, row_count long, digest string")
