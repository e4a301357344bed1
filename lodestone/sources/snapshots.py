"""Tables whose every change is one atomic step.

A table is a folder of immutable Parquet parts (``data/<id>``) and numbered
commits (``_commits/<n>.json``), each the whole list of the parts that are the
table at that version.  A change first writes its parts and then creates the
next commit *without overwriting*: of two writers one gets the number, the
other learns of it and decides anew.  Until its commit exists a change is
invisible, so a refresh that dies half-way leaves the old rows readable, and a
reader keeps the version it has resolved while others write.

* ``replace``: full refresh.  The last commit wins.
* ``append``: adds a part.  With a ``tag`` it takes the place of the part of
  that tag, so a repeated run or micro-batch leaves one part.
* ``Insert``: insert-if-absent against the version it was begun on; on a
  conflict only the parts that are new since then are compared by key.
* ``merge``: parts of a size tier become one part of the next tier, so a table
  of ``n`` appends has O(log n) parts.  Rows are the same before and after.

Commits are as long as the list of parts.  A reader starts at the version a
hint file names and looks for later ones; without a (readable) hint it lists
the commits.  ``vacuum`` removes folders that no kept commit names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts of one tier that are merged into one of the next.
FAN = 8
#: Rows of a file of a merged part.
FILE_ROWS = 1_000_000


@dataclass(frozen=True)
class Snapshot:
    """One version of a table: its parts, each ``{"path", "rows", "tier", ...}``."""
    root: str
    version: int
    schema: T.StructType
    parts: list = field(default_factory=list)

    @property
    def rows(self) -> int:
        return sum(p["rows"] for p in self.parts)


# ------------------------------------------------------------ file system

def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    fs, p = _file(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _file(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content unless it exists; whether it was
    created.  The content is written beside it first, and takes the name by a
    hard link on a local file system and by a rename, which does not replace
    files, on others."""
    fs, p = _file(spark, path)
    if fs.exists(p):
        return False
    beside = f"{path}.{uuid.uuid4().hex}"
    _write_text(spark, beside, text)
    q = spark._jvm.org.apache.hadoop.fs.Path(beside)
    if p.toUri().getScheme() in (None, "file") and fs.getScheme() == "file":
        paths = spark._jvm.java.nio.file.Paths
        at, to = (paths.get(x.toUri().getPath(), spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)) for x in (q, p))
        try:
            spark._jvm.java.nio.file.Files.createLink(to, at)
            return True
        except Exception as e:  # noqa: BLE001 - py4j wraps the Java exception
            if "FileAlreadyExists" not in str(e):
                raise
            return False
        finally:
            fs.delete(q, False)
    if fs.rename(q, p):
        return True
    fs.delete(q, False)
    return False


# ---------------------------------------------------------------- versions

def _commit_path(root: str, version: int) -> str:
    return f"{root}/_commits/{version:020d}.json"


def _load(spark: SparkSession, root: str, version: int) -> Snapshot | None:
    text = _read_text(spark, _commit_path(root, version))
    if text is None:
        return None
    c = json.loads(text)
    return Snapshot(root, version, T.StructType.fromJson(c["schema"]), c["parts"])


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The latest version of a table, None where nothing was ever committed."""
    root = root.rstrip("/")
    found = None
    hint = _read_text(spark, f"{root}/_commits/_last")
    if hint and hint.isdigit():
        found = _load(spark, root, int(hint))
    if found is None:
        fs, folder = _file(spark, f"{root}/_commits")
        if not fs.exists(folder):
            return None
        numbers = [int(s.getPath().getName()[:20]) for s in fs.listStatus(folder)
                   if len(s.getPath().getName()) == 25 and s.getPath().getName().endswith(".json")]
        if not numbers:
            return None
        found = _load(spark, root, max(numbers))
    while True:
        later = _load(spark, root, found.version + 1)
        if later is None:
            return found
        found = later


def commit(spark: SparkSession, root: str, base: Snapshot | None, schema: T.StructType, parts: list) -> Snapshot | None:
    """``parts`` as the version after ``base``; None where another writer has
    committed that version."""
    root = root.rstrip("/")
    version = base.version + 1 if base else 1
    text = json.dumps({"schema": schema.jsonValue(), "parts": parts})
    if not create_new(spark, _commit_path(root, version), text):
        return None
    _write_text(spark, f"{root}/_commits/_last", str(version), overwrite=True)
    return Snapshot(root, version, schema, parts)


def write_part(df: DataFrame, root: str, tier: int = 0, **about) -> dict:
    """The rows as a new part that no commit names yet; its entry."""
    name = f"data/{uuid.uuid4().hex}"
    rows = Observation(f"part_{uuid.uuid4().hex}")
    df.observe(rows, F.count(F.lit(1)).alias("rows")).write.parquet(f"{root.rstrip('/')}/{name}")
    return {"path": name, "rows": int(rows.get.get("rows", 0)), "tier": tier, **about}


def read_parts(spark: SparkSession, snap: Snapshot, parts: list | None = None) -> DataFrame:
    """The rows of a version, or of some of its parts."""
    parts = snap.parts if parts is None else parts
    if not parts:
        return spark.createDataFrame([], snap.schema)
    return spark.read.schema(snap.schema).parquet(*[f"{snap.root}/{p['path']}" for p in parts])


def read(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the latest version."""
    snap = current(spark, root)
    if snap is None:
        raise FileNotFoundError(f"no table at {root}")
    return read_parts(spark, snap)


def same_columns(a: T.StructType, b: T.StructType) -> bool:
    return [(f.name, f.dataType.simpleString()) for f in a.fields] == [(f.name, f.dataType.simpleString()) for f in b.fields]


def nullable(schema: T.StructType) -> T.StructType:
    """What the columns of stored rows are: any may be null."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


# ----------------------------------------------------------------- changes

def replace(df: DataFrame, root: str) -> int:
    """Full refresh: from its commit on the table is these rows.  Returns their
    number.  The frame may read the table it replaces."""
    spark, schema = df.sparkSession, nullable(df.schema)
    part = write_part(df, root)
    while commit(spark, root, current(spark, root), schema, [part]) is None:
        pass  # another writer was first; this refresh comes after it
    return part["rows"]


def append_part(spark: SparkSession, root: str, schema: T.StructType, part: dict) -> None:
    """Commit a written part; the part of the same ``tag`` goes in the same commit."""
    tag, schema = part.get("tag"), nullable(schema)
    while True:
        base = current(spark, root)
        if base and not same_columns(base.schema, schema):
            raise ValueError(f"columns {schema.simpleString()} do not fit the table's {base.schema.simpleString()}")
        kept = [p for p in base.parts if tag is None or p.get("tag") != tag] if base else []
        if commit(spark, root, base, base.schema if base else schema, [*kept, part]):
            return


def append(df: DataFrame, root: str, tag: str | None = None) -> int:
    """Add rows as a part, in place of the part of the same ``tag`` if there is one."""
    part = write_part(df, root, **({"tag": tag} if tag else {}))
    append_part(df.sparkSession, root, df.schema, part)
    return part["rows"]


class Insert:
    """Insert-if-absent, begun on the version that is current now.

    ``rows`` gives, for the keys of the table (None at first), the rows to add;
    it is asked again only if the table has lost parts meanwhile (a refresh or
    a merge), for then keys may be free again.  ``commit`` adds the rows in one
    step.  A version committed in between is compared by key with what it
    added, never the whole table again, and keys that it holds are not added a
    second time: they are left out, or, with ``refill``, ``rows`` is asked again.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], rows, schema: T.StructType, tag: str | None = None,
                 refill: bool = False):
        self.spark, self.root, self.keys, self.rows, self.tag, self.refill = spark, root.rstrip("/"), keys, rows, tag, refill
        self.schema = nullable(schema)
        self._begin()

    def _begin(self) -> None:
        self.base = current(self.spark, self.root)
        self.part = self._write(self.rows(self._held(self.base.parts) if self.base else None))

    def _write(self, df: DataFrame) -> dict:
        return write_part(df.select(*[f"`{f.name}`" for f in self.schema.fields]), self.root, **({"tag": self.tag} if self.tag else {}))

    def _held(self, parts: list) -> DataFrame:
        """The keys of the given parts; a part of this insert's own tag is its
        earlier attempt and does not count."""
        parts = [p for p in parts if not self.tag or p.get("tag") != self.tag]
        return read_parts(self.spark, self.base, parts).select(*self.keys)

    def picked(self) -> DataFrame:
        """The rows that this insert adds, as they stand now."""
        return read_parts(self.spark, Snapshot(self.root, 0, self.schema, [self.part]))

    def commit(self) -> int:
        while True:
            kept = [p for p in self.base.parts if not self.tag or p.get("tag") != self.tag] if self.base else []
            schema = self.base.schema if self.base else self.schema
            if commit(self.spark, self.root, self.base, schema, [*kept, self.part]):
                return self.part["rows"]
            before = {p["path"] for p in self.base.parts} if self.base else set()
            self.base = current(self.spark, self.root)
            paths = {p["path"] for p in self.base.parts}
            if not before <= paths:
                self._begin()
                continue
            mine, added = self.picked(), self._held([p for p in self.base.parts if p["path"] not in before])
            if mine.join(added, self.keys, "left_semi").isEmpty():
                continue
            if self.refill:
                self._begin()
            else:
                self.part = self._write(mine.join(added, self.keys, "left_anti"))


def merge(spark: SparkSession, root: str, reduce_rows=None, sort: list[str] | None = None, fan: int = FAN, hold: int = 1) -> int:
    """Merge tiers that have ``fan`` parts or more, each into one part of the
    next tier; returns how many parts went.  ``reduce_rows(df) -> df`` may
    drop rows that others of the same merge replace.  The last ``hold`` parts
    stay as they are (a repeated batch can still take the place of its part).
    Gives up where another writer has taken one of the parts."""
    gone = 0
    while True:
        base = current(spark, root)
        if base is None:
            return gone
        old = base.parts[:-hold] if hold else base.parts
        tiers: dict[int, list] = {}
        for p in old:
            tiers.setdefault(p["tier"], []).append(p)
        full = next((ps for t, ps in sorted(tiers.items()) if len(ps) >= fan), None)
        if full is None:
            return gone
        df = read_parts(spark, base, full)
        df = reduce_rows(df) if reduce_rows else df
        files = max(1, -(-sum(p["rows"] for p in full) // FILE_ROWS))
        df = df.repartitionByRange(files, *sort).sortWithinPartitions(*sort) if sort else df.repartition(files)
        part, taken = write_part(df, root, full[0]["tier"] + 1), {p["path"] for p in full}
        while True:
            if not taken <= {p["path"] for p in base.parts}:
                return gone
            # the merged part stands where the first of its parts stood: order of arrival is kept
            parts, put = [], False
            for p in base.parts:
                if p["path"] not in taken:
                    parts.append(p)
                elif not put:
                    parts, put = [*parts, part], True
            if commit(spark, root, base, base.schema, parts):
                break
            base = current(spark, root)
        gone += len(full)


def vacuum(spark: SparkSession, root: str, keep: int = 10) -> int:
    """Remove data folders that none of the last ``keep`` versions names, and
    the commits before those; returns how many folders went.  A part that is
    being written is named by no commit yet: run it while nothing writes."""
    snap = current(spark, root)
    if snap is None:
        return 0
    versions = [v for v in (_load(spark, snap.root, n) for n in range(max(1, snap.version - keep + 1), snap.version + 1)) if v]
    named = reduce(lambda a, v: a | {p["path"].split("/")[-1] for p in v.parts}, versions, set())
    fs, folder = _file(spark, f"{snap.root}/data")
    gone = 0
    for s in fs.listStatus(folder) if fs.exists(folder) else []:
        if s.getPath().getName() not in named:
            fs.delete(s.getPath(), True)
            gone += 1
    fs, folder = _file(spark, f"{snap.root}/_commits")
    for s in fs.listStatus(folder):
        name = s.getPath().getName()
        if len(name) == 25 and name.endswith(".json") and int(name[:20]) < versions[0].version:
            fs.delete(s.getPath(), False)
    return gone
