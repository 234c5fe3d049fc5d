"""Keyed change application on a stream, type 1, for tables in a format without ``MERGE``.

Layout below the target's folder, all written by Spark::

    changes/batch=N     newest row per key of micro-batch N, with a hash of the row; the file ``_SETTLED`` in it lists the
                        key buckets of its rows and is written last, so a batch counts once it is there
    settled/batch=N     the same without rows that the snapshot has newer versions of; only where there are such
    snapshots/upto=N    one row per key, batches up to N applied: a table bucketed by key, whole or of some buckets only
    owned/upto=N        a file with the buckets that snapshot N holds
    marks/upto=N        the newest version in any snapshot up to N

**Reading.** What readers see is a view: the snapshot rows whose keys have no pending change, and the newest pending row of
each key. Pending rows are newer than the snapshot's by construction, so a read of one column takes that column and the key
of the snapshot, and nothing else. Snapshots are tables bucketed by key: pending keys too many to broadcast are dealt to the
buckets, the snapshot itself is never shuffled, and a read of one key opens one bucket.

**Applying.** A micro-batch is reduced to its newest row per key and written; then the view's text is replaced. The cost follows
the batch. Only rows that are not newer than the mark, the newest version of all snapshots, are compared with the
snapshot's rows of their keys, and dropped if these are newer.

**Compacting.** Pending batches are folded in once they weigh a given share of the buckets they touch. If these are few, a
snapshot of only these buckets is written, and the others stay where they are: each bucket is read from the newest snapshot
that holds it. A first load in one batch is not rewritten before a second one comes. So over time each row is rewritten a bounded number of times, and changes to a few keys rewrite
a few buckets.

A snapshot counts once Spark has put its ``_SUCCESS`` mark there: a write cut short is ignored and done again, and readers keep
the snapshots they started on while these are among the newest. A micro-batch repeated after a restart replaces its own
folders with the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..catalog import Lake
from ..operators import latest_per_key

NOTHING_APPLIED = -1
# Numbers of buckets are powers of two between these, with about so many bytes in each.
FEWEST_BUCKETS, MOST_BUCKETS = 8, 1 << 16
BUCKET_BYTES = 1 << 27
ROW_HASH, BUCKET = "_row_hash", "_bucket"


def listed(names: Iterable[str], table: str = "") -> str:
    of = f"{table}." if table else ""
    return ", ".join(f"{of}`{name}`" for name in names)


def version_of(sequence: Sequence[str], table: str = "") -> str:
    """What orders versions of a key, as in ``latest_per_key``: the sequence, then a hash of the row."""
    return f"struct({listed([*sequence, ROW_HASH], table)})"


def newest_sql(columns: Sequence[str], keys: Sequence[str], sequence: Sequence[str], changes: str) -> str:
    """SQL for the newest row per key of ``changes``."""
    newest_first = ", ".join(f"`{name}` DESC" for name in [*sequence, ROW_HASH])
    return f"""
      SELECT {listed(columns)} FROM (
        SELECT *, row_number() OVER (PARTITION BY {listed(keys)} ORDER BY {newest_first}) AS _place FROM {changes})
      WHERE _place = 1"""


def merged_sql(
    columns: Sequence[str], keys: Sequence[str], snapshots: Sequence[str], newest: str, buckets: int | None = None
) -> str:
    """SQL for the snapshots, which hold a key once between them, with ``newest`` in place of the rows of its keys.

    Snapshot rows without nulls in their keys are compared by plain equality, which keeps the buckets of a snapshot as they
    are; the few with nulls, for which nulls are values like any other, apart. ``buckets`` deals the pending rows to so many.
    """
    plain = " AND ".join(f"s.`{key}` = n.`{key}`" for key in keys)
    null_safe = " AND ".join(f"s.`{key}` <=> n.`{key}`" for key in keys)
    some_null = " OR ".join(f"s.`{key}` IS NULL" for key in keys)
    parts = [
        f"SELECT {listed(columns, 's')} FROM ({snapshot}) s LEFT ANTI JOIN changed n ON {same} WHERE {which}"
        for snapshot in snapshots
        for same, which in ((plain, f"NOT ({some_null})"), (null_safe, f"({some_null})"))
    ]
    hint = f"/*+ REPARTITION({buckets}, {listed(keys)}) */ " if buckets else ""
    parts.append(f"SELECT {hint}{listed(columns)} FROM changed")
    return f"WITH changed AS ({newest}) " + " UNION ALL ".join(parts)


class ChangeTarget:
    """Dataset ``name`` of a lake, kept at one row per key by a stream of changes.

    ``buckets`` is by default found from the size of the first snapshot, and found anew when a whole snapshot is written that
    has outgrown it.
    """

    def __init__(
        self,
        lake: Lake,
        name: str,
        schema: T.StructType,
        keys: Sequence[str],
        sequence: Sequence[str],
        compact_share: float = 0.2,
        few_batches: int = 10,
        many_batches: int = 1000,
        keep_snapshots: int = 2,
        buckets: int | None = None,
        partial_share: float = 0.5,
        most_parts: int = 8,
    ) -> None:
        self.lake = lake
        self.spark = lake.spark
        self.name = name
        self.schema = schema
        self.keys = list(keys)
        self.sequence = list(sequence)
        self.compact_share = compact_share
        self.few_batches = few_batches
        self.many_batches = many_batches
        self.keep_snapshots = keep_snapshots
        self.partial_share = partial_share
        self.most_parts = most_parts
        self.folder = lake.folder(name)
        self._buckets = buckets
        self._sizes: dict[str, int] = {}
        self._held: dict[str, frozenset[int]] = {}

    # The target --------------------------------------------------------------------------------------

    def create(self) -> ChangeTarget:
        """The empty target, or a view on what an earlier run has written."""
        if not self._finished("snapshots", "upto"):
            empty = self.spark.createDataFrame([], self.schema)
            empty.write.mode("overwrite").parquet(self._snapshot(NOTHING_APPLIED))
        for version in self.parts():
            self._register(version)
        self._show()
        return self

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``."""
        names = self.schema.names
        newest = latest_per_key(batch.select(names), self.keys, self.sequence)
        newest = newest.withColumn(ROW_HASH, F.xxhash64(*names))
        newest.write.mode("overwrite").parquet(self._folder("changes", batch_id))
        self._settle(batch_id)
        for kind in ("changes", "settled"):
            self._sizes.pop(self._folder(kind, batch_id), None)
        self._show()
        if len(self.pending()) >= self.few_batches:
            self.compact_if_due()

    def start(self, changes: DataFrame) -> StreamingQuery:
        """Starts applying a stream of changes; ``compact_if_due`` is for the end of the run.

        Batch numbers are those of the checkpoint, so the checkpoint lives and dies with the target.
        """
        return (
            changes.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", f"{self.folder}/_checkpoint")
            .foreachBatch(self.apply)
            .start()
        )

    def current(self) -> DataFrame:
        """One row per key, pending batches included."""
        return self.spark.table(self.lake.table(self.name))

    def applied(self) -> int:
        return max(self._finished("snapshots", "upto"))

    def pending(self) -> list[int]:
        applied = self.applied()
        return sorted(batch for batch in self._finished("changes", "batch", "_SETTLED") if batch > applied)

    def buckets(self) -> int:
        """Buckets of the snapshots there are; each was written whole once. One, as long as there is none."""
        parts = self.parts()
        return len(frozenset().union(*(self._owned(version) for version in parts))) if parts else 1

    def _buckets_for(self, size: float) -> int:
        """Buckets of a whole snapshot of about this many bytes."""
        if self._buckets:
            return max(self._buckets, self.buckets())
        enough = FEWEST_BUCKETS
        while enough < MOST_BUCKETS and enough * BUCKET_BYTES < size:
            enough *= 2
        return max(enough, self.buckets())

    def parts(self, applied: int | None = None) -> dict[int, frozenset[int]]:
        """The snapshots that make up the state after ``applied``, with the buckets to be read from each."""
        versions = sorted(self._finished("snapshots", "upto"), reverse=True)
        found, seen = {}, frozenset()
        for version in versions:
            if version == NOTHING_APPLIED or (applied is not None and version > applied):
                continue
            mine = self._owned(version) - seen
            if mine:
                found[version] = mine
            seen |= mine
        return found

    # Compaction --------------------------------------------------------------------------------------

    def compact_if_due(self) -> None:
        """Compacts once the pending batches weigh enough beside the buckets they touch, or are too many to list.

        A first load in one batch holds a key once and is read as it is, so it waits for the next one, unless the share is 0.
        """
        pending = self.pending()
        if not pending or (len(pending) == 1 and not self.parts() and self.compact_share):
            return
        waiting = self._waiting(pending)
        share = len(self._touched(pending)) / self.buckets()
        weight = self._weight() or self._bytes(self._snapshot(NOTHING_APPLIED))
        if waiting > self.compact_share * share * weight or len(pending) >= self.many_batches:
            self.compact()

    def compact(self) -> int:
        """Folds the pending batches into a new snapshot, of the touched buckets if these are few; returns their number."""
        pending = self.pending()
        if not pending:
            return 0
        upto, buckets, parts = pending[-1], self.buckets(), self.parts()
        touched = self._touched(pending)
        if not parts or len(touched) > self.partial_share * buckets or len(parts) >= self.most_parts:
            buckets = self._buckets_for(self._weight() + self._waiting(pending))
            touched = frozenset(range(buckets))
        columns = [*self.schema.names, ROW_HASH]
        snapshots = [self._bucket_files(version, mine & touched) for version, mine in parts.items() if mine & touched]
        # Snapshot rows stay in the tasks that read them; pending ones are dealt, so that a bucket gets few files.
        rows = self.spark.sql(merged_sql(columns, self.keys, snapshots, self._newest(columns, pending), buckets))
        if parts and buckets != self.buckets():
            rows = rows.repartition(buckets, *self.keys)
        self._record(upto, touched, pending)
        writer = rows.withColumn(BUCKET, self._bucket_of_row(buckets)).write.format("parquet")
        writer = writer.bucketBy(buckets, *self.keys).sortBy(*self.keys).mode("overwrite")
        writer.option("path", self._snapshot(upto)).saveAsTable(self._table(upto))
        self._show()
        self.prune()
        return len(pending)

    def _waiting(self, pending: list[int]) -> int:
        return sum(self._bytes(self._change(batch)) for batch in pending)

    def _weight(self) -> float:
        """Bytes of what is read from the snapshots."""
        return sum(
            self._bytes(self._snapshot(version)) * len(mine) / len(self._owned(version))
            for version, mine in self.parts().items()
        )

    def prune(self) -> None:
        """Deletes what only readers of an older state than the newest ``keep_snapshots`` could need."""
        states = sorted(self._finished("snapshots", "upto"))[-self.keep_snapshots :]
        needed = {version for state in states for version in self.parts(state)} | set(states)
        for number in self._numbers("snapshots/upto=*"):
            if number < states[-1] and number not in needed:
                if number != NOTHING_APPLIED:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self._table(number)}")
                for kind in ("snapshots", "owned", "marks"):
                    self._delete(f"{self.folder}/{kind}/upto={number}")
        for number in self._numbers("changes/batch=*"):
            if number <= states[0]:
                for kind in ("settled", "changes"):
                    self._delete(self._folder(kind, number))

    def _record(self, upto: int, touched: frozenset[int], pending: list[int]) -> None:
        """What is known of a snapshot beside its rows; it counts when the snapshot does."""
        self._list_numbers(f"{self.folder}/owned/upto={upto}", touched)
        marks = f"SELECT max({version_of(self.sequence)}) AS mark FROM {self._changes(pending)}"
        if self.applied() != NOTHING_APPLIED:
            marks += f" UNION ALL SELECT mark FROM parquet.`{self._mark(self.applied())}`"
        newest = self.spark.sql(f"SELECT max(mark) AS mark FROM ({marks})")
        newest.coalesce(1).write.mode("overwrite").parquet(self._mark(upto))

    def _settle(self, batch_id: int) -> None:
        """Keeps rows that the snapshot has newer versions of from being pending, and lets the batch count."""
        changes = f"parquet.`{self._folder('changes', batch_id)}`"
        applied = self.applied()
        version, late = version_of(self.sequence), "FALSE"
        if NOTHING_APPLIED < applied < batch_id:
            late = f"coalesce({version} <= (SELECT mark FROM parquet.`{self._mark(applied)}`), TRUE)"
        bucket = f"pmod(hash({listed(self.keys)}), {self.buckets()})"
        # At most one number for each bucket reaches the driver.
        facts = self.spark.sql(f"SELECT collect_set({bucket}) AS touched, any({late}) AS late FROM {changes}").first()
        self._delete(self._folder("settled", batch_id))
        if facts.late:
            late_rows = f"SELECT * FROM {changes} WHERE {late}"
            snapshot = " UNION ALL ".join(f"SELECT * FROM ({part})" for part in self._snapshots())
            same = " AND ".join(f"s.`{key}` <=> n.`{key}`" for key in self.keys)
            newer = (
                f"SELECT {listed(self.keys, 'n')} FROM ({snapshot}) s JOIN late n ON {same} "
                f"WHERE {version_of(self.sequence, 's')} >= {version_of(self.sequence, 'n')}"
            )
            kept = self.spark.sql(
                f"WITH late AS ({late_rows}), newer AS ({newer}) "
                f"SELECT c.* FROM {changes} c LEFT ANTI JOIN newer n ON {same.replace('s.', 'c.')}"
            )
            kept.write.mode("overwrite").parquet(self._folder("settled", batch_id))
        self._list_numbers(f"{self._folder('changes', batch_id)}/_SETTLED", facts.touched)

    # SQL ---------------------------------------------------------------------------------------------

    def _show(self) -> None:
        """Replaces the view, in one catalog operation, by one on what is finished now."""
        columns, pending = self.schema.names, self.pending()
        snapshots = self._snapshots()
        if not pending:
            empty = [f"SELECT {listed(columns)} FROM parquet.`{self._snapshot(NOTHING_APPLIED)}`"]
            query = " UNION ALL ".join(f"SELECT {listed(columns)} FROM ({part})" for part in snapshots or empty)
        elif snapshots:
            query = merged_sql(columns, self.keys, snapshots, self._newest(columns, pending))
        else:
            query = self._newest(columns, pending)
        self.lake.show(self.name, query)

    def _snapshots(self) -> list[str]:
        """A query for each snapshot that is read, less the buckets that are read from a newer one."""
        found = []
        for version, mine in self.parts().items():
            old = sorted(self._owned(version) - mine)
            which = f" WHERE `{BUCKET}` NOT IN ({', '.join(map(str, old))})" if old else ""
            found.append(f"SELECT * FROM {self._table(version)}{which}")
        return found

    def _bucket_files(self, version: int, buckets: frozenset[int]) -> str:
        """A query for some buckets of a snapshot: only their files are opened, which are named by bucket."""
        if buckets == self._owned(version):
            return f"SELECT * FROM {self._table(version)}"
        names = ",".join(f"{bucket:05d}" for bucket in sorted(buckets))
        return f"SELECT * FROM parquet.`{self._snapshot(version)}/*_{{{names}}}.c*`"

    def _newest(self, columns: Sequence[str], pending: list[int]) -> str:
        changes = self._changes(pending)
        if len(pending) == 1:  # one row per key already
            return f"SELECT {listed(columns)} FROM {changes}"
        return newest_sql(columns, self.keys, self.sequence, changes)

    def _changes(self, pending: list[int]) -> str:
        folders = ",".join(self._change(batch)[len(self.folder) + 1 :] for batch in pending)
        return f"parquet.`{self.folder}/{{{folders}}}`"

    def _bucket_of_row(self, buckets: int | None = None):
        """The bucket of a row, as Spark's bucketed tables have it."""
        return F.pmod(F.hash(*self.keys), F.lit(buckets or self.buckets()))

    # Folders -----------------------------------------------------------------------------------------

    def _table(self, version: int) -> str:
        return f"{self.lake.table(self.name)}_upto_{version}"

    def _register(self, version: int) -> None:
        fields = [*self.schema.fields, T.StructField(ROW_HASH, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._table(version)} ({columns}) USING parquet "
            f"CLUSTERED BY ({listed(self.keys)}) SORTED BY ({listed(self.keys)}) INTO {self.buckets()} BUCKETS "
            f"LOCATION '{self._snapshot(version)}'"
        )

    def _touched(self, pending: list[int]) -> frozenset[int]:
        return frozenset().union(*(self._numbers_in(f"{self._folder('changes', batch)}/_SETTLED") for batch in pending))

    def _owned(self, version: int) -> frozenset[int]:
        return self._numbers_in(f"{self.folder}/owned/upto={version}")

    def _list_numbers(self, file: str, numbers: Iterable[int]) -> None:
        """A small file of numbers, at most one for each bucket."""
        stream = self._file_system().create(self._path(file), True)
        stream.write(",".join(map(str, sorted(numbers))).encode())
        stream.close()
        self._held.pop(file, None)

    def _numbers_in(self, file: str) -> frozenset[int]:
        """The numbers in such a file. Read once, as it does not change."""
        if file not in self._held:
            stream = self._file_system().open(self._path(file))
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            self._held[file] = frozenset(map(int, filter(None, text.split(","))))
        return self._held[file]

    def _snapshot(self, upto: int) -> str:
        return f"{self.folder}/snapshots/upto={upto}"

    def _mark(self, upto: int) -> str:
        return f"{self.folder}/marks/upto={upto}"

    def _folder(self, kind: str, batch: int) -> str:
        return f"{self.folder}/{kind}/batch={batch}"

    def _change(self, batch: int) -> str:
        """Where the rows of a batch are read."""
        settled = self._path(f"{self._folder('settled', batch)}/_SUCCESS")
        return self._folder("settled" if self._file_system().exists(settled) else "changes", batch)

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _file_system(self):
        configuration = self.spark._jsc.hadoopConfiguration()
        return self._path(self.folder).getFileSystem(configuration)

    def _finished(self, kind: str, label: str, mark: str = "_SUCCESS") -> list[int]:
        """Numbers of the finished folders of one kind; ``compact`` keeps them few."""
        return self._numbers(f"{kind}/{label}=*/{mark}")

    def _numbers(self, pattern: str) -> list[int]:
        found = self._file_system().globStatus(self._path(f"{self.folder}/{pattern}")) or []
        paths = [status.getPath() for status in found]
        folders = [path.getParent() if path.getName().startswith("_") else path for path in paths]
        return [int(folder.getName().split("=")[1]) for folder in folders]

    def _bytes(self, folder: str) -> int:
        """Size of a finished folder; listed once, as it does not change."""
        if folder not in self._sizes:
            summary = self._file_system().getContentSummary(self._path(folder))
            self._sizes[folder] = summary.getLength()
        return self._sizes[folder]

    def _delete(self, folder: str) -> None:
        self._file_system().delete(self._path(folder), True)
