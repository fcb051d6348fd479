"""Tables of one row per key that change by appending: base rows, deltas, and a log that says which count.

A change writes its own rows and a short log entry, however large the table is. Readers
put base and deltas together; compaction rewrites only the ranges of keys in which deltas
have grown large.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docweir.operators.upsert import last_wins

#: Bits of the hash of a key; a range of keys is a stretch of hashes.
TOKEN_BITS = 63
#: Rows that a range of a new base is meant for, and the most ranges there are.
RANGE_ROWS, MAX_RANGE_BITS = 1_000_000, 12
#: Deltas that are left side by side, and the share of a range's base rows that its deltas may reach.
MAX_DELTAS, MAX_SHARE = 8, 0.25
_TOKEN, _ORDER, _RESET, _DELETED = "_token", "_order", "_reset", "_deleted"


@dataclass(frozen=True)
class Segment:
    """Files that were written together: of which ranges their rows still count, and how many those are."""

    name: str
    base: bool
    schema: str
    rows: dict[int, int]


@dataclass(frozen=True)
class State:
    """What a table consists of: segments from the oldest to the newest, and the last batch of each writer."""

    version: int = 0
    keys: list[str] = field(default_factory=list)
    sticky: list[str] = field(default_factory=list)
    bits: int = 0
    segments: list[Segment] = field(default_factory=list)
    applied: dict[str, int] = field(default_factory=dict)

    @staticmethod
    def parsed(text: str) -> State:
        raw = json.loads(text)
        segments = [Segment(s["name"], s["base"], s["schema"], {int(k): n for k, n in s["rows"].items()}) for s in raw.pop("segments")]
        return State(segments=segments, **raw)


class Conflict(Exception):
    """Another writer has written this version."""


class KeyedTable:
    """A keyed table at a path of any file system that can rename a file without replacing another.

    ``keys`` may hold nulls, which are equal to each other. ``sticky`` columns keep their
    last value that is neither null nor empty. Both are stated when the table is first
    written, and kept. Columns may be added by later rows.

    A version of the table is a log entry of its own, complete when it appears under its
    number; what it names is never changed. So a reader sees one version, before or after
    a change, whenever it comes and wherever a writer fails; of two writers that want the
    same number, one takes the next.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str] | None = None, sticky: list[str] | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.sticky = keys, sticky
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    # Log

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def versions(self) -> list[int]:
        log = self._path("log")
        names = [s.getPath().getName() for s in self._fs.listStatus(log)] if self._fs.exists(log) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def state(self, version: int | None = None) -> State:
        """The newest version, or a given one."""
        found = self.versions()
        if not found:
            return State(keys=self.keys or [], sticky=self.sticky or [])
        name = self._path(f"log/{found[-1] if version is None else version:020d}.json")
        stream = self._fs.open(name)
        try:
            return State.parsed(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _commit(self, state: State) -> None:
        """Make ``state`` the table's newest version, or raise if there is one of its number."""
        text = json.dumps(asdict(state), ensure_ascii=False)
        draft, final = self._path(f"log/.{uuid.uuid4().hex}"), self._path(f"log/{state.version:020d}.json")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        no_options = self.spark.sparkContext._gateway.new_array(getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            files.rename(self._fs.makeQualified(draft), self._fs.makeQualified(final), no_options)
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            if "AlreadyExists" in error.java_exception.getClass().getName():
                raise Conflict(state.version) from error
            raise

    def _committed(self, change) -> State:
        """Commit what ``change`` makes of the newest state, or of the one that came before us."""
        while True:
            state = change(self.state())
            if state is None:
                return self.state()
            try:
                self._commit(state)
            except Conflict:
                continue
            return state

    # Segments

    def _range(self, bits: int) -> Column:
        return F.shiftrightunsigned(F.col(_TOKEN), TOKEN_BITS - bits).cast("int")

    def _write(self, rows: DataFrame, base: bool, bits: int, keys: list[str]) -> Segment:
        """Rows as files in the order of their keys' hashes, so that a range lies in few row groups."""
        name = f"{'base' if base else 'delta'}-{uuid.uuid4().hex}"
        token = F.shiftrightunsigned(F.xxhash64(*keys), 64 - TOKEN_BITS)
        path = f"{self.path}/data/{name}"
        rows.withColumn(_TOKEN, token).repartitionByRange(_TOKEN).sortWithinPartitions(_TOKEN).write.parquet(path)
        schema = self.spark.read.parquet(path).schema
        counts = self.spark.read.schema(schema).parquet(path).groupBy(self._range(bits).alias("r")).count().collect()
        return Segment(name, base, schema.json(), {r["r"]: r["count"] for r in counts})

    def _rows(self, segment: Segment, bits: int, ranges: set[int] | None = None) -> DataFrame:
        """The rows of a segment that count, or those in some ranges; files elsewhere are passed over by their statistics."""
        schema = StructType.fromJson(json.loads(segment.schema))
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/data/{segment.name}")
        wanted = sorted(set(segment.rows) if ranges is None else ranges & set(segment.rows))
        if not wanted:
            return rows.where(F.lit(False))
        if len(wanted) < 1 << bits:
            width = 1 << (TOKEN_BITS - bits)
            low, last = wanted[0] * width, (wanted[-1] + 1) * width - 1
            rows = rows.where(F.col(_TOKEN).between(low, last) & self._range(bits).isin(wanted))
        return rows

    def _union(self, state: State, segments: list[tuple[int, Segment]], ranges: set[int] | None) -> DataFrame | None:
        out = None
        for order, segment in segments:
            rows = self._rows(segment, state.bits, ranges).withColumn(_ORDER, F.lit(order))
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        return out

    def _merged(self, rows: DataFrame, state: State) -> DataFrame:
        """One row per key of rows of several segments, each of which holds a key once: so a key has as many rows as there are segments at most.

        What came before a key's last reset is forgotten; a deleted row stays as one.
        """
        values = [c for c in rows.columns if c not in {*state.keys, _TOKEN, _ORDER, _RESET, _DELETED}]
        row = F.struct(_ORDER, _RESET, _DELETED, *values)
        in_order = F.array_sort(F.collect_list(row), lambda a, b: a[_ORDER] - b[_ORDER])
        grouped = rows.groupBy(_TOKEN, *state.keys).agg(in_order.alias("_all"))
        last_reset = F.coalesce(F.array_max(F.transform(F.filter("_all", lambda v: v[_RESET]), lambda v: v[_ORDER])), F.lit(-1))
        live = grouped.withColumn("_reset_at", last_reset).withColumn("_live", F.filter("_all", lambda v: v[_ORDER] >= F.col("_reset_at")))

        def given(c: str) -> Column:
            some = F.filter("_live", lambda v: F.coalesce(v[c].cast("string"), F.lit("")) != "")
            return F.get(some, F.size(some) - 1)[c]

        last = F.element_at("_live", -1)
        columns = [(given(c) if c in state.sticky else last[c]).alias(c) for c in values]
        return live.select(_TOKEN, *state.keys, (F.col("_reset_at") >= 0).alias(_RESET), last[_DELETED].alias(_DELETED), *columns)

    def _current(self, state: State, ranges: set[int] | None = None) -> DataFrame | None:
        """All rows, or those of some ranges, with the hash of their keys and no deleted ones.

        Base rows whose keys no delta holds pass through as they are; only the others are
        grouped. Where deltas are small, the engine sends them to the base rows.
        """
        segments = list(enumerate(state.segments))
        base = self._union(state, [s for s in segments if s[1].base], ranges)
        deltas = self._union(state, [s for s in segments if not s[1].base], ranges)
        if base is None and deltas is None:
            return None
        if deltas is None:
            return base.drop(_ORDER, _RESET, _DELETED)
        changed = deltas
        if base is not None:
            names = [F.col(k).alias(f"_k{i}") for i, k in enumerate(state.keys)]
            # Keys of deltas once each; a key that two deltas hold is no matter to either join.
            held = deltas.select(F.col(_TOKEN).alias("_t"), *names)
            same = F.col(_TOKEN) == F.col("_t")
            for i, k in enumerate(state.keys):
                same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
            changed = deltas.unionByName(base.join(held, same, "left_semi"), allowMissingColumns=True)
        merged = self._merged(changed, state).where(~F.col(_DELETED)).drop(_RESET, _DELETED)
        if base is None:
            return merged
        return merged.unionByName(base.join(held, same, "left_anti").drop(_ORDER, _RESET, _DELETED), allowMissingColumns=True)

    # Use

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        """The table as it is, or as it was in a version whose segments are still there."""
        state = self.state(version)
        rows = self._current(state)
        if rows is None:
            raise ValueError(f"there is no table at {self.path}")
        return rows.drop(_TOKEN)

    def _append(self, rows: DataFrame, writer: str | None, batch: int | None) -> State:
        state = self.state()
        done = writer is not None and state.applied.get(writer, -1) >= batch
        if done:
            return state
        if not state.keys:
            raise ValueError("a new table needs keys")
        first = not state.segments
        bits = self._bits(rows.count()) if first else state.bits
        segment = self._write(rows, False, bits, state.keys)

        def change(now: State) -> State | None:
            if writer is not None and now.applied.get(writer, -1) >= batch:
                return None
            found = now.bits if now.segments else bits
            own = segment if found == bits else replace(segment, rows=self._counts(segment, found))  # another writer was first
            applied = now.applied if writer is None else now.applied | {writer: batch}
            return replace(now, version=now.version + 1, bits=found, segments=[*now.segments, own], applied=applied)

        return self._committed(change)

    def _counts(self, segment: Segment, bits: int) -> dict[int, int]:
        schema = StructType.fromJson(json.loads(segment.schema))
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/data/{segment.name}")
        return {r["r"]: r["count"] for r in rows.groupBy(self._range(bits).alias("r")).count().collect()}

    @staticmethod
    def _bits(rows: int) -> int:
        return min(MAX_RANGE_BITS, max(0, (-(-rows // RANGE_ROWS) - 1).bit_length()))

    def upsert(self, incoming: DataFrame, seq: list[str] | None = None, writer: str | None = None, batch: int | None = None) -> State:
        """Put ``incoming`` into the table; of its rows with one key the last by ``seq`` counts, or the greatest by value.

        A ``writer`` numbers its batches; one that the table has already is passed over, so
        that a batch can be sent again after a failure.
        """
        state = self.state()
        rows = last_wins(incoming, state.keys, seq or [], sticky=[c for c in state.sticky if c in incoming.columns]).drop(*(seq or []))
        return self._append(rows.withColumns({_RESET: F.lit(False), _DELETED: F.lit(False)}), writer, batch)

    def delete(self, gone: DataFrame, writer: str | None = None, batch: int | None = None) -> State:
        """Take out the rows of the keys in ``gone``; what is put in later under such a key begins anew."""
        keys = gone.select(*self.state().keys).distinct()
        return self._append(keys.withColumns({_RESET: F.lit(True), _DELETED: F.lit(True)}), writer, batch)

    def compact(self, max_share: float = MAX_SHARE, max_deltas: int = MAX_DELTAS) -> State:
        """Rewrite the ranges whose deltas exceed a share of their base; else, of too many deltas, make one.

        What is not due is not read. Appends that come meanwhile stay as they are.
        """
        state = self.state()
        deltas = [s for s in state.segments if not s.base]
        base_rows, delta_rows = ({} for _ in range(2))
        for s in state.segments:
            into = base_rows if s.base else delta_rows
            for r, n in s.rows.items():
                into[r] = into.get(r, 0) + n
        due = {r for r, n in delta_rows.items() if n > max_share * base_rows.get(r, 0)}
        if due:
            return self._replaced(state, [s for s in state.segments if due & set(s.rows)], due, True)
        return self._replaced(state, deltas, None, False) if len(deltas) > max_deltas else state

    def _replaced(self, state: State, old: list[Segment], ranges: set[int] | None, base: bool) -> State:
        """Put one new segment in the place of old ones, in some ranges or in all of theirs."""
        if base:
            rows = self._current(state, ranges).drop(_TOKEN).withColumns({_RESET: F.lit(False), _DELETED: F.lit(False)})
        else:
            placed = [(k, s) for k, s in enumerate(state.segments) if s in old]
            rows = self._merged(self._union(state, placed, ranges), state).drop(_TOKEN)
        new = self._write(rows, base, state.bits, state.keys)
        names = {s.name for s in old}

        def change(now: State) -> State | None:
            there = {s.name: s for s in now.segments}
            if any(there.get(s.name) != s for s in old):
                return None  # another compaction was first; this one's files are swept up later
            kept = []
            for s in now.segments:
                left = s.rows if s.name not in names else {r: n for r, n in s.rows.items() if ranges is not None and r not in ranges}
                if left:
                    kept.append(replace(s, rows=left))
            # In its ranges nothing older is left; it stands before all deltas that came since.
            at = 0 if base else min((k for k, s in enumerate(kept) if now.segments.index(there[s.name]) > now.segments.index(there[old[-1].name])), default=len(kept))
            return replace(now, version=now.version + 1, segments=[*kept[:at], *([new] if new.rows else []), *kept[at:]])

        return self._committed(change)

    def vacuum(self, keep_versions: int = 2, grace_ms: int = 86_400_000) -> list[str]:
        """Delete versions that were replaced ``grace_ms`` ago, but not the newest ones, and files that no other version names; names of what went.

        So a reader has that long to end, and a writer to commit what it has written.
        """
        found = self.versions()
        now = self._jvm.java.lang.System.currentTimeMillis()
        replaced = {v: self._fs.getFileStatus(self._path(f"log/{after:020d}.json")).getModificationTime() for v, after in zip(found, found[1:], strict=False)}
        newest = set(found[-max(1, keep_versions) :])
        kept = [v for v in found if v in newest or now - replaced[v] < grace_ms]
        named = {s.name for v in kept for s in self.state(v).segments}
        gone = []
        for v in set(found) - set(kept):
            self._fs.delete(self._path(f"log/{v:020d}.json"), False)
        data = self._path("data")
        for status in self._fs.listStatus(data) if self._fs.exists(data) else []:
            name = status.getPath().getName()
            if name not in named and now - status.getModificationTime() >= grace_ms:
                self._fs.delete(status.getPath(), True)
                gone.append(name)
        return gone
