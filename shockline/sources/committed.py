"""An insert-only Parquet table with commits, for merges by id that read little of the table.

    data/_folder=<name>/_p=p<prefix>/    rows, by the first letters of their id (ids are hex digests, so prefixes are even)
    blooms/_folder=<name>/_p=p<prefix>/  a Bloom filter of the folder's ids for each prefix, as numbered 64-bit words
    log/<version>.json                   the commits; a folder that no commit names is not part of the table
    log/base                             the version of the last compaction, from which on the log has to be read

A merge reads the filters of the batch's prefixes, and of the rows only the parts whose filter has one of the batch's ids. It
writes a folder and then its commit, under the next version and only if that version isn't there: of two writers one
loses, sees which commits came between, looks at these alone for its own ids and tries again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a filter for each id; each id sets three of one word.
BITS = 16


class CommitConflict(RuntimeError):
    """Other commits came first, more often than was allowed."""


@dataclass
class Commit:
    version: int
    folder: str | None
    #: Rows of each prefix.
    rows: dict[str, int] = field(default_factory=dict)
    #: Words of a filter of this folder.
    words: int = 0
    writer: str | None = None
    batch_id: int | None = None
    #: The highest batch of each writer in what a compaction replaced.
    batches: dict[str, int] = field(default_factory=dict)
    #: Versions that this commit lost to before it went through.
    lost_to: list[int] = field(default_factory=list)


@dataclass
class Merge:
    """What a merge did: rows that it inserted, parts of the table, and how many of them it had to read."""

    version: int | None
    inserted: int
    parts: int
    parts_read: int
    lost_to: list[int]


class Files:
    """The store's own operations, by the session's file systems."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        fs = p.getFileSystem(self.conf)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def read(self, name: str) -> str | None:
        p = self.path(name)
        fs = p.getFileSystem(self.conf)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        p = self.path(name)
        stream = p.getFileSystem(self.conf).create(p, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Whether the file is new. It appears whole or not at all: a rename that doesn't overwrite, which is atomic in the store."""
        part = f"{name.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        self.write(part, text)
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
        options[0] = rename.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(name).toUri(), self.conf).rename(self.path(part), self.path(name), options)
            return True
        except Exception as e:  # noqa: BLE001
            if "FileAlreadyExistsException" not in str(e):
                raise
            return False
        finally:
            self.delete(part)

    def delete(self, name: str) -> None:
        p = self.path(name)
        p.getFileSystem(self.conf).delete(p, True)


class CommittedTable:
    """Rows by a key that is a hex digest; a row that is there is never changed by a merge."""

    def __init__(self, spark: SparkSession, path: str, key: str = "signal_id", prefix: int = 2):
        self.spark, self.path, self.key, self.prefix = spark, path, key, prefix
        self.files = Files(spark)

    def log(self) -> list[Commit]:
        """Commits that make up the table, in order. Names are listed, and only commits from the last compaction on are read."""
        base = int(self.files.read(f"{self.path}/log/base") or 0)
        found = [n for n in self.files.names(f"{self.path}/log") if n.endswith(".json") and not n.startswith(".") and int(n[:-5]) >= base]
        return [Commit(**json.loads(self.files.read(f"{self.path}/log/{n}"))) for n in found]

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows as of a version from the last compaction on, or now; None before the first commit with rows."""
        folders = [c.folder for c in self.log() if c.folder and (version is None or c.version <= version)]
        return self._parts(folders) if folders else None

    def _parts(self, parts: Iterable[str]) -> DataFrame:
        """Rows of folders, or of parts of them as candidates() names them."""
        data = f"{self.path}/data"
        return self.spark.read.option("basePath", data).parquet(*(f"{data}/_folder={p}" for p in parts)).drop("_folder", "_p")

    def _prefixed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_p", F.concat(F.lit("p"), F.substring(self.key, 1, self.prefix)))

    def _bit(self) -> tuple[Column, Column]:
        """Hash from which the word is taken, and the word's bits, of a key."""
        h = F.xxhash64(self.key)
        return F.shiftrightunsigned(h, 18), F.expr(" | ".join(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(`{self.key}`), {6 * k}) & 63 as int))" for k in range(3)))

    def _write(self, rows: DataFrame) -> Commit:
        """A folder of rows and its filters, not yet part of the table."""
        folder = f"f{uuid.uuid4().hex}"  # a letter first: not to be taken for a number
        # prefixes are even, so a large batch makes even files; a small one makes one file a prefix
        self._prefixed(rows).repartition("_p").write.partitionBy("_p").parquet(f"{self.path}/data/_folder={folder}")
        if not any(n.startswith("_p=") for n in self.files.names(f"{self.path}/data/_folder={folder}")):
            self.files.delete(f"{self.path}/data/_folder={folder}")
            return Commit(0, None)
        ids = self._prefixed(self._parts([folder]).select(self.key))
        counts = {r["_p"]: r["n"] for r in ids.groupBy("_p").agg(F.count("*").alias("n")).collect()}  # 16 ** prefix rows at most
        words = 1 << max(0, (max(counts.values()) * BITS // 64 - 1).bit_length())
        h, bits = self._bit()
        ids.groupBy("_p", F.pmod(h, F.lit(words)).alias("word")).agg(F.bit_or(bits).alias("bits")).repartition("_p").write.partitionBy("_p").parquet(f"{self.path}/blooms/_folder={folder}")
        return Commit(0, folder, counts, words)

    def _drop(self, c: Commit) -> None:
        for kind in ("data", "blooms"):
            if c.folder:
                self.files.delete(f"{self.path}/{kind}/_folder={c.folder}")

    def candidates(self, batch: DataFrame, commits: list[Commit]) -> list[str]:
        """Parts (folder/_p=prefix) that may have one of the batch's ids: by prefixes, then by the filters of these prefixes."""
        prefixes = {r["_p"] for r in self._prefixed(batch.select(self.key)).select("_p").distinct().collect()}
        possible = {c.folder: c.words for c in commits if c.folder and prefixes & set(c.rows)}
        if not possible:
            return []
        reader = self.spark.read.schema("word long, bits long, _folder string, _p string").option("basePath", f"{self.path}/blooms")
        blooms = reader.parquet(*(f"{self.path}/blooms/_folder={c.folder}/_p={p}" for c in commits if c.folder in possible for p in sorted(prefixes & set(c.rows))))
        sizes = F.create_map(*(x for f, w in possible.items() for x in (F.lit(f), F.lit(w))))
        h, bits = self._bit()
        asked = self._prefixed(batch.select(self.key)).select("_p", h.alias("_h"), bits.alias("_bits"), F.explode(F.array(*map(F.lit, sorted(set(possible.values()))))).alias("_words"))
        asked = asked.select("_p", "_bits", "_words", F.pmod("_h", F.col("_words")).alias("word"))
        hits = blooms.withColumn("_words", sizes[F.col("_folder")]).join(asked, ["_p", "_words", "word"]).where("bits & _bits = _bits")
        return [f"{r['_folder']}/_p={r['_p']}" for r in hits.select("_folder", "_p").distinct().collect()]

    def merge(self, batch: DataFrame, writer: str | None = None, batch_id: int | None = None, retries: int = 5, before_commit=None) -> Merge:
        """Insert the batch's rows whose ids the table lacks, each id once.

        With writer and batch_id a batch that is already there is left out, so a stream may repeat it. A batch that
        ended before its commit is not part of the table. Commits of others in between are looked at for the batch's ids and
        the commit is tried again, `retries` times, before CommitConflict is raised. before_commit() is called before each try.
        """
        rows = batch.dropDuplicates([self.key]).persist()
        try:
            log, made, lost, read, inserted = self.log(), None, [], 0, 0
            if writer is not None and batch_id is not None and any(c.writer == writer and c.batch_id == batch_id or c.batches.get(writer, -1) >= batch_id for c in log):
                return Merge(None, 0, sum(len(c.rows) for c in log), 0, [])
            fresh = log
            for _ in range(retries + 1):
                parts = self.candidates(rows, fresh)
                read += len(parts)
                if parts or made is None:
                    known = self._parts(parts).select(self.key) if parts else None
                    new = rows if known is None else rows.join(known, self.key, "left_anti")
                    if made is not None:
                        new = self._parts([made.folder]).join(known, self.key, "left_anti") if made.folder else new.limit(0)
                    old, made = made, self._write(new)
                    if old is not None:
                        self._drop(old)
                if before_commit is not None:
                    before_commit()
                made.version, made.writer, made.batch_id, made.lost_to = log[-1].version + 1 if log else 1, writer, batch_id, lost
                if self._commit(made):
                    return Merge(made.version, sum(made.rows.values()), sum(len(c.rows) for c in log), read, lost)
                last = log[-1].version if log else 0
                log = self.log()
                fresh = [c for c in log if c.version > last]
                lost = [*lost, *(c.version for c in fresh)]
            self._drop(made)
            raise CommitConflict(f"lost to versions {lost}")
        finally:
            rows.unpersist()

    def _commit(self, c: Commit) -> bool:
        return self.files.create(f"{self.path}/log/{c.version:012d}.json", json.dumps(asdict(c)))

    def compact(self) -> int | None:
        """All rows in one folder, with one part a prefix; the version. A writer that comes first wins: CommitConflict.

        Folders before stay for readers that are under way; vacuum() removes them.
        """
        log = self.log()
        if len(log) < 2:
            return None
        rows = self.read()
        made = self._write(rows) if rows is not None else Commit(0, None)
        made.version = log[-1].version + 1
        for c in log:
            for w, b in [*c.batches.items(), *([(c.writer, c.batch_id)] if c.writer is not None and c.batch_id is not None else [])]:
                made.batches[w] = max(b, made.batches.get(w, -1))
        if not self._commit(made):
            self._drop(made)
            raise CommitConflict(f"version {made.version} was committed during the compaction")
        self.files.write(f"{self.path}/log/base", str(made.version))
        return made.version

    def vacuum(self) -> list[str]:
        """Remove folders that no commit from the last compaction on names; call it when no writer or earlier reader is under way."""
        named = {c.folder for c in self.log()}
        gone = [n for f in self.files.names(f"{self.path}/data") if (n := f.removeprefix("_folder=")) not in named]
        for n in gone:
            self._drop(Commit(0, n))
        return gone
