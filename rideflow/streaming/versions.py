"""Updated rows of a stream as a table of bounded size: a folder per micro-batch, merged now and then, and a log of what counts.

The table is what the newest entry of the log names: ``final`` folders with rows that no event can change any
more, one ``open`` folder with the newest version of the others, and the micro-batches since. Folders are
named by the batch that wrote them and nothing is changed in place, so a batch that is repeated after a
failure writes the same folders again, and readers see the entry before until the new one is renamed into place.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rideflow.streaming.sinks import TRIGGER, triggered

#: Micro-batches between merges, and final folders of one size that are merged into one of the next.
MERGE_EVERY, MERGE_FINAL = 10, 4
#: Entries of the log that stay, so that a reader of an older one still finds its folders.
KEPT_ENTRIES = 3


@dataclass(frozen=True)
class Entry:
    """One state of the table. ``final`` lists folders with how often their rows were merged."""

    batch: int
    batches: tuple[int, ...] = ()
    open: str | None = None
    final: tuple[tuple[str, int], ...] = ()

    def folders(self) -> set[str]:
        return {f"batch={b}" for b in self.batches} | {f for f, _ in self.final} | ({self.open} if self.open else set())


@dataclass
class Versions:
    """The table at ``path``. ``keys`` tell a row; rows of which ``ends`` lies before ``until`` are final.

    ``until`` gives, for the rows that a merge reads, the time before which the stream's watermark drops all
    events from the next batch on. ``schema`` is that of the rows.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    ends: str
    until: Callable[[DataFrame], DataFrame]
    merge_every: int = MERGE_EVERY
    schema: object = field(default=None)

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def entries(self) -> list[int]:
        """Batches with an entry in the log, oldest first."""
        files, log = self._files(), self._at("log")
        if not files.exists(log):
            return []
        names = [f.getPath().getName() for f in files.listStatus(log)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))

    def entry(self, batch: int | None = None) -> Entry:
        """The newest state, or that after a batch."""
        known = self.entries()
        if not known:
            return Entry(-1)
        text = self.spark.read.text(f"{self.path}/log/{known[-1] if batch is None else batch}.json", wholetext=True).first()[0]
        found = json.loads(text)
        return Entry(found["batch"], tuple(found["batches"]), found["open"], tuple((f, n) for f, n in found["final"]))

    def _commit(self, entry: Entry) -> None:
        """Write the entry beside the log and rename it into place."""
        files, hidden, shown = self._files(), self._at(f"log/_{entry.batch}.json"), self._at(f"log/{entry.batch}.json")
        out = files.create(hidden, True)
        out.write(bytearray(json.dumps(asdict(entry)).encode()))
        out.close()
        if files.exists(shown):
            files.delete(shown, False)
        if not files.rename(hidden, shown):
            raise RuntimeError(f"cannot write {shown}")

    def _read(self, folders: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def _newest(self, entry: Entry) -> DataFrame:
        """The newest version of each row that is not final."""
        folders = [f"batch={b}" for b in entry.batches] + ([entry.open] if entry.open else [])
        values = [c for c in self.schema.names if c not in self.keys]
        return self._read(folders).groupBy(*self.keys).agg(*(F.max_by(c, "_version").alias(c) for c in values)).select(*self.schema.names)

    def rows(self) -> DataFrame:
        """The table: final rows as they are, and the newest version of the others."""
        entry = self.entry()
        if self.schema is None:
            if not entry.folders():
                raise ValueError("the table is empty and has no schema")
            self.schema = self.spark.read.parquet(f"{self.path}/{sorted(entry.folders())[0]}").schema
        parts = [self._read([f for f, _ in entry.final])] if entry.final else []
        if entry.open or entry.batches:
            parts.append(self._newest(entry))
        out = parts[0] if parts else self.spark.createDataFrame([], self.schema)
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.drop("_version")

    def add(self, rows: DataFrame, batch: int) -> None:
        """Write a micro-batch, merge if it is time, commit. A repeated batch starts from the state before it."""
        versioned = rows.withColumn("_version", F.lit(batch).cast("long"))
        self.schema = versioned.schema
        earlier = [b for b in self.entries() if b < batch]
        entry = self.entry(earlier[-1]) if earlier else Entry(-1)
        versioned.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        entry = replace(entry, batch=batch, batches=(*entry.batches, batch))
        if len(entry.batches) >= self.merge_every:
            entry = self._merged(entry)
        self._commit(entry)
        self._forget()

    def _merged(self, entry: Entry) -> Entry:
        """The state with its batches merged: rows that are finished go to a final folder, the others to a new open one."""
        newest, open_, done = self._newest(entry), f"open-{entry.batch}", f"final-{entry.batch}"
        until = self.until(newest).first()[0]
        over = F.coalesce(F.col(self.ends) <= F.lit(until), F.lit(False))
        newest.withColumn("_part", F.when(over, done).otherwise(open_)).write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/merge-{entry.batch}")
        folder = f"merge-{entry.batch}/_part="
        there = lambda name: self._files().exists(self._at(folder + name))
        final = entry.final + (((folder + done, 0),) if there(done) else ())
        state = Entry(entry.batch, (), folder + open_ if there(open_) else None, final)
        return self._merged_final(state)

    def _merged_final(self, entry: Entry) -> Entry:
        """Final folders of one size become one of the next, so their number grows with the logarithm of the batches."""
        for size in range(len(entry.final)):
            same = [f for f, n in entry.final if n == size]
            if len(same) < MERGE_FINAL:
                continue
            name = f"final-{entry.batch}-{size + 1}"
            self._read(same).write.mode("overwrite").parquet(f"{self.path}/{name}")
            entry = replace(entry, final=(*((f, n) for f, n in entry.final if n != size), (name, size + 1)))
        return entry

    def _forget(self) -> None:
        """Delete old entries and the folders that no kept entry names."""
        files, known = self._files(), self.entries()
        named = set().union(*(self.entry(b).folders() for b in known[-KEPT_ENTRIES:]))
        tops = {f.split("/")[0] for f in named}
        for status in files.listStatus(self._at("")):
            name = status.getPath().getName()
            if name != "log" and name not in tops:
                files.delete(status.getPath(), True)
        for batch in known[:-KEPT_ENTRIES]:
            files.delete(self._at(f"log/{batch}.json"), False)


def window_table(spark: SparkSession, path: str, keys: Sequence[str], delay: str, merge_every: int = MERGE_EVERY) -> Versions:
    """The table of windowed rows with ``window_start`` and ``window_end`` of a stream with a watermark of ``delay``.

    A window holds an event no earlier than its start, so the watermark lies at most the delay
    before the latest start.
    """
    until = lambda rows: rows.agg((F.max("window_start") - F.expr(f"INTERVAL {delay}")).alias("until"))
    return Versions(spark, path, keys, "window_end", until, merge_every)


def to_table(
    stream: DataFrame,
    table: Versions,
    checkpoint: str,
    drain: bool = False,
    every: str = TRIGGER,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Changed rows of a stream into the table; ``prepare`` may join what only the rows of a micro-batch need."""

    def add(rows: DataFrame, batch: int) -> None:
        if prepare is None:
            return table.add(rows, batch)
        kept = rows.persist()
        try:
            return table.add(prepare(kept), batch)
        finally:
            kept.unpersist()

    writer = stream.writeStream.outputMode("update").foreachBatch(add)
    return triggered(writer.option("checkpointLocation", checkpoint), drain, every).start()
