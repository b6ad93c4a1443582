"""Sink: a versioned Parquet index in hash buckets with deltas, idempotent upserts, and state kept as an event log."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.relational import current_state


class Index:
    """Rows by key in hash buckets; a bucket is a base and the deltas upserted since, merged when read.

    Folders ``v-*`` hold the files of one write by bucket and never change; a numbered manifest names the folders of each bucket in order.  A manifest
    is put in place by a rename that fails if its number exists, so writers never overwrite each other and readers see whole versions.  An
    upsert writes its own rows only; a bucket with more than ``DELTAS`` folders is rewritten alone; ``vacuum`` deletes what no manifest kept names.
    Rows of a folder are sorted by ``cluster`` (then by key), so filters on those columns skip row groups.
    """

    #: Folders of a bucket beyond which it is rewritten, and bytes of a bucket when an index is created.
    DELTAS, BUCKET_BYTES = 8, 128 << 20

    def __init__(self, spark: SparkSession, root: str, keys: list[str] | None = None, cluster: str | list[str] | None = None, buckets: int | None = None):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.keys, self.cluster = keys or ["_id"], [cluster] if isinstance(cluster, str) else list(cluster or [])
        self.jvm = spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(self.root).getFileSystem(self.conf)

    # ---- manifests
    def versions(self) -> list[int]:
        if not self.fs.exists(self.path(self.root)):
            return []
        names = (s.getPath().getName() for s in self.fs.listStatus(self.path(self.root)))
        return sorted(int(n[9:17]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def exists(self) -> bool:
        return bool(self.versions())

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version (the newest): number, keys, buckets, schema, and the folders of each bucket in order."""
        version = self.versions()[-1] if version is None else version
        return json.loads(self.spark.read.text(f"{self.root}/manifest-{version:08d}.json", wholetext=True).first()[0])

    def _commit(self, m: dict) -> None:
        tmp = self.path(f"{self.root}/.tmp.{uuid.uuid4().hex}")
        out = self.fs.create(tmp)
        out.write(bytearray(json.dumps(m).encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(self.root).toUri(), self.conf)
        none = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(tmp, self.path(f"{self.root}/manifest-{m['version']:08d}.json"), none)
        except Exception as e:
            self.fs.delete(tmp, False)
            raise RuntimeError(f"another writer has committed version {m['version']}") from e

    def check(self) -> None:
        """Raise unless the index's folder can be written, before any work is done."""
        probe = self.path(f"{self.root}/.probe.{uuid.uuid4().hex}")
        self.fs.create(probe).close()
        self.fs.delete(probe, False)

    # ---- reading
    def read(self, version: int | None = None, buckets: list[str] | None = None, bucket: str | None = None) -> DataFrame:
        """The live rows; ``buckets``: of these only; ``bucket``: a name for a column with each row's bucket."""
        m = self.manifest(version)
        of = {b: f for b, f in m["folders"].items() if buckets is None or b in buckets}
        clean = [f"{self.root}/{f[0]}/_b={b}" for b, f in of.items() if len(f) == 1]
        dirty = [f"{self.root}/{x}/_b={b}" for b, f in of.items() if len(f) > 1 for x in f]
        scan = lambda paths: self.spark.read.schema(m["schema"] + ", _seq long, _part boolean, _gone boolean").parquet(*paths)
        rows = None
        if clean or not dirty:
            rows = scan(clean) if clean else self.spark.createDataFrame([], m["schema"] + ", _gone boolean")
            rows = rows.where("not _gone")
        if dirty:
            merged = _merge(scan(dirty), m["keys"], F.col("_seq"), m["partial"]).where("not _gone")
            rows = merged if rows is None else rows.select(merged.columns).unionByName(merged)
        out = [F.col(f"`{c}`") for c in self._columns(m)]
        return rows.select(*out, *([_bucket(m["keys"], m["buckets"]).alias(bucket)] if bucket else []))

    def _columns(self, m: dict) -> list[str]:
        return [f.name for f in T.StructType.fromDDL(m["schema"])]

    # ---- writing
    def write(self, df: DataFrame, overwrite: bool = False, order: list[str] | None = None) -> None:
        """Create the index; an existing one is only replaced if asked."""
        if self.exists() and not overwrite:
            raise FileExistsError(self.root)
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        n = self.buckets or max(8, min(1 << 14, size // self.BUCKET_BYTES if size < 1 << 60 else 8))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        last = self.versions()[-1:] or [0]
        m = {"version": last[0] + 1, "keys": self.keys, "cluster": self.cluster, "buckets": n, "schema": schema, "partial": False, "folders": {}}
        self._add(m, df, False, order, {})

    def upsert(self, changes: DataFrame, partial: bool = False, order: list[str] | None = None) -> None:
        """Rows of equal key are replaced; running it twice changes nothing.

        ``partial``: a null in the change keeps the old value.  Of equal keys within the batch the last one in ``order`` wins; without an order such
        a batch is refused and nothing is changed.
        """
        if not self.exists():
            return self.write(changes, order=order)
        m = self.manifest()
        extra = [c for c in order or [] if c not in self._columns(m)]
        kinds = {f.name: f.dataType for f in T.StructType.fromDDL(m["schema"])}
        rows = changes.select(*[(F.col(f"`{c}`") if c in changes.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()], *extra)
        self._add(m | {"version": m["version"] + 1, "partial": m["partial"] or partial}, rows, partial, order, m["folders"])
        self.compact(self.DELTAS)

    def delete(self, keys: DataFrame) -> None:
        """Rows with these keys go."""
        m = self.manifest()
        kinds = {f.name: f.dataType for f in T.StructType.fromDDL(m["schema"])}
        rows = keys.select(*m["keys"]).distinct().select(*[(F.col(f"`{c}`") if c in m["keys"] else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])
        self._add(m | {"version": m["version"] + 1}, rows, False, None, m["folders"], gone=True)

    def compact(self, most: int = 1) -> list[str]:
        """Rewrite the buckets of more than ``most`` folders, and return them."""
        m = self.manifest()
        many = [b for b, f in m["folders"].items() if len(f) > most]
        if many:
            kept = {b: f for b, f in m["folders"].items() if b not in many}
            self._add(m | {"version": m["version"] + 1}, self.read(m["version"], many), False, None, kept)
        return many

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the manifests before the last ``keep`` and the folders that only they name; returns those.

        Folders of writers at work are named by no manifest yet: run it while nothing is written.
        """
        versions = self.versions()
        named = {f for v in versions[-keep:] for x in self.manifest(v)["folders"].values() for f in x}
        for v in versions[:-keep]:
            self.fs.delete(self.path(f"{self.root}/manifest-{v:08d}.json"), False)
        old = [n for s in self.fs.listStatus(self.path(self.root)) if (n := s.getPath().getName()).startswith("v-") and n not in named]
        for n in old:
            self.fs.delete(self.path(f"{self.root}/{n}"), True)
        return old

    def _add(self, m: dict, df: DataFrame, partial: bool, order: list[str] | None, before: dict, gone: bool = False) -> None:
        """Write rows as a folder, and commit it as the last one of each bucket that it touches."""
        keys, folder, own = m["keys"], f"v-{uuid.uuid4().hex}", self._columns(m)
        if order:
            df = _merge(df, keys, F.struct(*order), partial).select(*[F.col(f"`{c}`") for c in own])
        marks = {"_b": _bucket(keys, m["buckets"]), "_seq": F.lit(m["version"]).cast("long"), "_part": F.lit(partial), "_gone": F.lit(gone)}
        rows = df.withColumns(marks).repartition(F.col("_b")).sortWithinPartitions("_b", *m["cluster"], *keys)
        rows.write.partitionBy("_b").parquet(f"{self.root}/{folder}")
        touched = sorted(n[3:] for s in self.fs.listStatus(self.path(f"{self.root}/{folder}")) if (n := s.getPath().getName()).startswith("_b="))
        if not order and not gone and touched:
            written = self.spark.read.schema(m["schema"]).parquet(*[f"{self.root}/{folder}/_b={b}" for b in touched])
            if written.groupBy(*keys).count().where("count > 1").limit(1).count():
                self.fs.delete(self.path(f"{self.root}/{folder}"), True)
                raise ValueError("equal keys within the batch, and no order to choose by")
        self._commit(m | {"folders": before | {b: [*before.get(b, []), folder] for b in touched}})


def _bucket(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def _merge(rows: DataFrame, keys: list[str], order: Column, partial: bool) -> DataFrame:
    """One row a key: the last one, or with partial rows each column's last value that a whole row or a filled one gives."""
    rest = [c for c in rows.columns if c not in keys]
    if not partial:
        got = rows.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), order).alias("_r"))
        return got.select(*keys, *[F.col("_r")[c].alias(c) for c in rest])
    whole = ~F.col("_part") if "_part" in rest else F.lit(False)
    marks = ("_gone", "_part", "_seq")
    last = lambda c: F.max_by(c, order if c in marks else F.when(whole | F.col(f"`{c}`").isNotNull(), order))
    return rows.groupBy(*keys).agg(*[last(c).alias(c) for c in rest])


class Derived:
    """A table made of each bucket of an index, under a folder of its own; only changed buckets are made again.

    A bucket may be dealt to up to ``PARTS`` parts, which are numbered through: part p of bucket b is ``b * PARTS + p``.
    """

    PARTS = 4096

    def __init__(self, index: Index, root: str):
        self.index, self.spark, self.root = index, index.spark, root.rstrip("/")
        self.kept = Index(index.spark, root)  # for its manifests

    def _made(self, rows: DataFrame, parts: int) -> DataFrame:
        """Rows of the table, with an int column ``bucket`` (numbered through), from rows of the index with their ``_bucket``."""
        raise NotImplementedError

    def refresh(self, again: bool = False) -> list[str]:
        """Make what the index's newest version has changed (or all ``again``); returns those buckets."""
        m = self.index.manifest()
        was = self.kept.manifest() if self.kept.exists() else {"version": 0, "of": {}, "folders": {}}
        changed = [b for b, f in m["folders"].items() if again or was["of"].get(b) != f]
        gone = [b for b in was["of"] if b not in m["folders"]]
        if not changed and not gone and was["version"]:
            return []
        out, folder = self._made(self.index.read(m["version"], changed, "_bucket"), max(1, len(changed))), f"v-{uuid.uuid4().hex}"
        out.withColumn("_b", F.expr(f"bucket div {self.PARTS}")).write.partitionBy("_b").parquet(f"{self.root}/{folder}")
        made = {s.getPath().getName()[3:] for s in self.kept.fs.listStatus(self.kept.path(f"{self.root}/{folder}"))}
        folders = {b: f for b, f in was["folders"].items() if b not in changed and b not in gone} | {b: [folder] for b in changed if b in made}
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
        self.kept._commit({"version": was["version"] + 1, "of": m["folders"], "folders": folders, "schema": schema})
        return changed

    def table(self, buckets: list[str] | None = None) -> DataFrame:
        """The rows made, of some buckets or of all."""
        m = self.kept.manifest()
        paths = [f"{self.root}/{f[0]}/_b={b}" for b, f in m["folders"].items() if buckets is None or b in buckets]
        return self.spark.read.schema(m["schema"]).parquet(*paths) if paths else self.spark.createDataFrame([], m["schema"])


class StateLog:
    """Append-only events; the state of a key is the last non-null value of each column."""

    def __init__(self, spark: SparkSession, path: str, key: str = "id_zakona"):
        self.spark, self.path, self.key = spark, path, key

    def exists(self) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def append(self, events: DataFrame) -> None:
        events.withColumns({"at": F.current_timestamp(), "seq": F.monotonically_increasing_id()}).write.mode("append").parquet(self.path)

    def state(self) -> DataFrame:
        return current_state(self.spark.read.parquet(self.path), self.key, ["at", "seq"])

    def in_phase(self, *phases: str) -> DataFrame:
        return self.state().where(F.col("phase").isin(*phases))

    def to_download(self) -> DataFrame:
        """Everything but what is downloaded, done or known to be a scan; errors are tried again."""
        return self.state().where(~F.coalesce("phase", F.lit("")).isin("downloaded", "done", "scan"))

    def counts(self) -> DataFrame:
        return self.state().groupBy("phase").agg(F.count("*").alias("n"))


def quarantine(df: DataFrame, good, path: str) -> DataFrame:
    """Write rows that fail a condition as JSON lines; return the others."""
    df.where(~F.coalesce(good, F.lit(False))).write.mode("overwrite").json(path)
    return df.where(good)


def nested(paragraphs: DataFrame) -> DataFrame:
    """One row a law with its paragraphs as an array."""
    law = ["id_zakona", "akt_citace", "akt_nazev", "rok", "datum_od", "datum_do", "je_zrusen", "sbirka"]
    item = F.struct(F.col("paragraf_pos").try_cast("int").alias("pos"), F.col("iri").alias("iris"), "eli", "citace", "text", "hierarchie", "fragment_id", "typ")
    return paragraphs.groupBy(*law).agg(F.array_sort(F.collect_list(item)).alias("paragrafy"))


def unnested(laws: DataFrame) -> DataFrame:
    return laws.select(*[c for c in laws.columns if c != "paragrafy"], F.explode("paragrafy").alias("p")).select("*", "p.*").drop("p", "paragrafy")
