"""What a keyed table consists of, read newest day first, and compacted beside live writers.

A keyed table has a folder for each batch of each query, split by day:

    query_id=…/batch_id=…/day=…                         as written
    _compacted/rows/query_id=…/upto=…/day=…             the days of batches up to ``upto``, in one place

A compacted day holds what its batches hold that can still be read: of every key the query's last version, stamped with
the batch that wrote it and the time of the query's first, and every row without a key. It appears by the rename of one
folder, and from then on readers who list the table take it in place of those batches. So at every moment each version
is read once, and it makes no difference to a reader whether a day is compacted. The newest batch of a query is never
compacted: it may be unfinished, or repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date
import logging
from urllib.parse import unquote
import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)

VERSION_COLUMNS = "ingested_at timestamp, query_id string, batch_id bigint, day date"
#: Below a name that Spark's own listing of the table passes over.
COMPACTED = "_compacted/rows"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _files(spark: SparkSession, path: str):
    """The path, and the file system it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    place, system = _files(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(place) or []]


def delete(spark: SparkSession, path: str) -> None:
    place, system = _files(spark, path)
    system.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _files(spark, path)
    return system.exists(place)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a folder to a place that does not exist yet, at once."""
    source, system = _files(spark, old)
    target, _ = _files(spark, new)
    system.mkdirs(target.getParent())
    if system.exists(target) or not system.rename(source, target):
        raise FileExistsError(f"{old} cannot become {new}")


@dataclass(frozen=True)
class Part:
    """A day's folder of one batch, or of all batches up to one."""

    query_id: str
    upto: int
    day: date | None
    compacted: bool
    path: str

    @classmethod
    def at(cls, path: str, compacted: bool) -> Part:
        query_id, batch, day = (unquote(level.split("=", 1)[1]) for level in path.rsplit("/", 3)[1:])
        return cls(query_id, int(batch), None if day == NO_DAY else date.fromisoformat(day), compacted, path)


def parts(spark: SparkSession, path: str) -> list[Part]:
    """Every day's folder that is stored, whether or not another has replaced it. Only names are listed.

    Compacted days are listed last: what they replace is still there then, or was listed before it was deleted.
    """
    batches = [Part.at(p, False) for p in _matching(spark, f"{path}/query_id=*/batch_id=*/day=*")]
    return batches + [Part.at(p, True) for p in _matching(spark, f"{path}/{COMPACTED}/query_id=*/upto=*/day=*")]


def current_parts(known: Iterable[Part]) -> list[Part]:
    """Those a reader takes: of every query and day the latest compaction, and the batches after it."""
    known = list(known)
    reached: dict[tuple[str, date | None], int] = {}
    for part in known:
        if part.compacted:
            key = part.query_id, part.day
            reached[key] = max(part.upto, reached.get(key, part.upto))

    def taken(part: Part) -> bool:
        upto = reached.get((part.query_id, part.day))
        return upto is None or (part.upto == upto if part.compacted else part.upto > upto)

    return [part for part in known if taken(part)]


def read_parts(spark: SparkSession, path: str, columns: StructType, chosen: Iterable[Part]) -> DataFrame:
    """The versions in these folders, and only they are listed."""
    stored = StructType(columns.fields + StructType.fromDDL(VERSION_COLUMNS).fields)
    names = stored.names
    folders: dict[bool, list[str]] = {False: [], True: []}
    for part in chosen:
        folders[part.compacted].append(part.path)
    frames = []
    for compacted, base in ((False, path), (True, f"{path}/{COMPACTED}")):
        if folders[compacted]:
            place, system = _files(spark, base)
            base = system.makeQualified(place).toString()
            frames.append(
                spark.read.schema(stored).option("basePath", base).parquet(*folders[compacted]).select(*names))
    if not frames:
        return spark.createDataFrame([], stored)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def read_stored(spark: SparkSession, path: str, columns: StructType, since: date | None = None) -> DataFrame:
    """Every version of a keyed table, or those of a day and later, which rows without a day are not."""
    chosen = current_parts(parts(spark, path))
    if since is None:
        return read_parts(spark, path, columns, chosen)
    chosen = [part for part in chosen if part.day is not None and part.day >= since]
    return read_parts(spark, path, columns, chosen).filter(F.col("day") >= F.lit(since))


def newest_days(
    spark: SparkSession, path: str, columns: StructType, build: Callable[[DataFrame], DataFrame], least: int
) -> DataFrame:
    """``build`` of the newest days that give it ``least`` rows, or of all of them.

    Days come from the names of folders, newest first; as long as there are too few rows twice as many days are read. What
    is counted is one column of the days already chosen, so that a read costs what the newest days hold and not the
    history. Rows without a day belong to every reading.
    """
    chosen = current_parts(parts(spark, path))
    days = sorted({part.day for part in chosen if part.day is not None}, reverse=True)
    width = 1
    while True:
        first = days[min(width, len(days)) - 1] if days else None
        rows = read_parts(
            spark, path, columns, [part for part in chosen if part.day is None or part.day >= first])
        if first is not None:
            rows = rows.filter(F.col("day").isNull() | (F.col("day") >= F.lit(first)))
        found = build(rows)
        if width >= len(days) or found.select("row_key").limit(least).count() >= least:
            return found
        width *= 2


def compact_days(spark: SparkSession, path: str, columns: StructType, before: str | date) -> list[Part]:
    """Put the closed days, those before ``before``, of every query into one place each; jobs may go on writing.

    Days without new batches are left as they are. Rows that come late for a closed day are read from their batch until
    the next compaction takes them in. Returns the days published. What they replace stays for those who are reading it,
    until ``drop_replaced``.
    """
    before = date.fromisoformat(str(before))
    written: dict[str, set[int]] = {}
    for folder in _matching(spark, f"{path}/query_id=*/batch_id=*"):
        query_id, batch = (unquote(level.split("=", 1)[1]) for level in folder.rsplit("/", 2)[1:])
        written.setdefault(query_id, set()).add(int(batch))
    known = current_parts(parts(spark, path))
    published = []
    for query_id, batches in sorted(written.items()):
        upto = max(batches - {max(batches)}, default=None)
        own = [p for p in known if p.query_id == query_id and p.day is not None and p.day < before
               and upto is not None and (p.compacted or p.upto <= upto)]
        due = {p.day for p in own if not p.compacted}
        if due:
            published += _publish(spark, path, columns, query_id, upto, [p for p in own if p.day in due])
    return published


def _publish(
    spark: SparkSession, path: str, columns: StructType, query_id: str, upto: int, replaced: list[Part]
) -> list[Part]:
    rows = read_parts(spark, path, columns, replaced).repartitionByRange("day", "row_key")
    staging = f"{path}/_compacted/staging-{uuid.uuid4().hex[:12]}"
    (
        _last_of_query(rows).drop("query_id").sortWithinPartitions("day", "row_key")
        .write.partitionBy("day").parquet(staging)
    )
    made = []
    for folder in _matching(spark, f"{staging}/day=*"):
        target = f"{path}/{COMPACTED}/query_id={query_id}/upto={upto}/{folder.rsplit('/', 1)[1]}"
        rename(spark, folder, target)
        made.append(Part.at(target, True))
    delete(spark, staging)
    log.info("%s: %d days of query %s compacted up to batch %d", path, len(made), query_id, upto)
    return made


def _last_of_query(rows: DataFrame) -> DataFrame:
    """The last version of each key of one query on each day, with the time of the first; and all rows without a key.

    Ranges of the day and the key bring versions together, so the windows need no shuffle of their own.
    """
    of_key = Window.partitionBy("day", "row_key")
    last = (
        rows.filter("row_key IS NOT NULL")
        .withColumn("ingested_at", F.min("ingested_at").over(of_key))
        .withColumn("rn", F.row_number().over(of_key.orderBy(F.desc("batch_id")))).filter("rn = 1").drop("rn")
    )
    return last.unionByName(rows.filter("row_key IS NULL"))


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete the folders that a compaction has replaced, and return their number.

    Readers who listed the table before that compaction must have finished.
    """
    known = parts(spark, path)
    taken = set(current_parts(known))
    old = [part for part in known if part not in taken]
    for part in old:
        delete(spark, part.path)
    return len(old)
