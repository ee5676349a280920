"""Records that come page by page: a data source whose tasks read ranges of pages.

A page is what one request gives: page 1, 2, ... until an empty one. Here a page is a folder
``page=N`` of JSON lines, with a folder in it for each load that added records. Tasks first look where the pages end (they
ask whether pages exist, and read none), then each reads its own range of those before the first
empty one. A page after a gap is never read, as a client that stops at the empty page never asks for it.

As a stream the source keeps its place, (page, records of it already read), in the query's
checkpoint: a later run reads only what was added, on the last page too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ordered

#: Records on a page, and pages a task reads.
PAGE_ROWS, PAGES_PER_TASK = 1000, 64
RECORDS, ENDS = "paged_records", "paged_ends"


def write_pages(df: DataFrame, path: str, order: list[str], page_rows: int = PAGE_ROWS) -> None:
    """Records in the given order, one folder of JSON lines for each page."""
    add_pages(df, path, order, 0, page_rows)


def add_pages(df: DataFrame, path: str, order: list[str], present: int, page_rows: int = PAGE_ROWS) -> None:
    """Further records behind the ``present`` ones: they fill the last page up, then begin new ones."""
    at = F.col(ordered.RN) - 1 + present
    pages = ordered.number_rows(df, [], order).withColumn("page", F.floor(at / page_rows) + 1)
    # A page's records come from one task, in order. A later file of a page must not sort before an earlier
    # one, as the place within the page is the cursor: each load writes a folder of its own.
    rows = pages.repartition("page").sortWithinPartitions("page", ordered.RN).drop(ordered.RN)
    rows.withColumn("load", F.lit(f"{present:015d}")).write.mode("append").partitionBy("page", "load").json(path)


def _sources():
    """The source classes. They are made in a function so that Spark sends them to its workers whole."""
    import json

    from pyarrow import fs
    from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

    class Range(InputPartition):
        """Pages from ``first`` to before ``stop``, without the first ``skip`` records of the first one;
        of page ``stop`` the records before number ``upto``."""

        def __init__(self, first: int, stop: int, skip: int = 0, upto: int = 0):
            super().__init__(None)
            self.first, self.stop, self.skip, self.upto = first, stop, skip, upto

    class Pages:
        def __init__(self, path: str):
            plain = "/" + path.split(":", 1)[1].lstrip("/") if path.startswith("file:") else path
            self.files, self.root = fs.FileSystem.from_uri(plain)

        def listed(self, page: int) -> list[str]:
            found = self.files.get_file_info(fs.FileSelector(f"{self.root}/page={page}", allow_not_found=True, recursive=True))
            return sorted(f.path for f in found if f.is_file and f.size and not f.base_name.startswith(("_", ".")))

        def records(self, page: int):
            for file in self.listed(page):
                with self.files.open_input_stream(file) as lines:
                    rest = b""
                    while chunk := lines.read(1 << 20):
                        *whole, rest = (rest + chunk).split(b"\n")
                        yield from (json.loads(line) for line in whole if line)
                    if rest:
                        yield json.loads(rest)

        def bound(self, page: int) -> int:
            """An empty page at or after ``page``, found in steps that double; the first empty one is no later."""
            step = 1
            while self.listed(page):
                page, step = page + step, 2 * step
            return page

    def ranges(first: int, stop: int, size: int) -> list[Range]:
        return [Range(a, min(a + size, stop)) for a in range(first, stop, size)]

    class EndsReader(DataSourceReader):
        def __init__(self, options):
            self.pages, self.size = Pages(options["path"]), int(options["pagespertask"])

        def partitions(self):
            return ranges(1, self.pages.bound(1) + 1, self.size)

        def read(self, part):
            for page in range(part.first, part.stop):
                if not self.pages.listed(page):
                    yield (page,)
                    return

    class Ends(DataSource):
        """The first empty page of each range."""

        @classmethod
        def name(cls):
            return ENDS

        def schema(self):
            return "page long"

        def reader(self, schema):
            return EndsReader(self.options)

    def rows(pages: Pages, part: Range):
        for page in range(part.first, part.stop + 1):
            last = page == part.stop
            if last and not part.upto:
                return
            for place, record in enumerate(pages.records(page)):
                if last and place >= part.upto:
                    return
                if page > part.first or place >= part.skip:
                    yield (json.dumps(record), page)

    class RecordsReader(DataSourceReader):
        def __init__(self, options):
            self.pages, self.stop, self.size = Pages(options["path"]), int(options["stop"]), int(options["pagespertask"])

        def partitions(self):
            return ranges(1, self.stop, self.size) or [Range(1, 1)]

        def read(self, part):
            return rows(self.pages, part)

    class RecordsStream(DataSourceStreamReader):
        def __init__(self, options):
            self.pages, self.size = Pages(options["path"]), int(options["pagespertask"])
            self.place = None

        def initialOffset(self):
            return {"page": 1, "records": 0}

        def latestOffset(self):
            """The last page that is not empty, and how many records it has now."""
            page = self.place or 1
            while self.pages.listed(page + 1):
                page += 1
            self.place = page
            return {"page": page, "records": sum(1 for _ in self.pages.records(page))}

        def partitions(self, start, end):
            self.place = max(self.place or 1, start["page"])
            parts = ranges(start["page"], end["page"], self.size)
            if not parts:
                parts = [Range(start["page"], end["page"])]
            parts[0].skip, parts[-1].upto = start["records"], end["records"]
            return parts

        def read(self, part):
            return rows(self.pages, part)

    class Records(DataSource):
        """(record, page): each record as JSON text, typed by the caller's schema on Spark's side."""

        @classmethod
        def name(cls):
            return RECORDS

        def schema(self):
            return "record string, page long"

        def reader(self, schema):
            return RecordsReader(self.options)

        def streamReader(self, schema):
            return RecordsStream(self.options)

    return Ends, Records


def register(spark: SparkSession) -> None:
    for source in _sources():
        spark.dataSource.register(source)


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(F.from_json("record", schema).alias("r"), "page").select("r.*", "page")


def read_pages(spark: SparkSession, path: str, schema: T.StructType, pages_per_task: int = PAGES_PER_TASK) -> DataFrame:
    """The records of pages 1, 2, ... before the first empty one, with their page."""
    register(spark)
    options = {"path": path, "pagespertask": pages_per_task}
    stop = spark.read.format(ENDS).options(**options).load().agg(F.min("page")).first()[0]
    return _typed(spark.read.format(RECORDS).options(stop=stop, **options).load(), schema)


def page_stream(spark: SparkSession, path: str, schema: T.StructType, pages_per_task: int = PAGES_PER_TASK) -> DataFrame:
    """The records as a stream that goes on where its checkpoint ends."""
    register(spark)
    return _typed(spark.readStream.format(RECORDS).option("path", path).option("pagespertask", pages_per_task).load(), schema)


def load_new(spark: SparkSession, path: str, schema: T.StructType, target: str, checkpoint: str,
             pages_per_task: int = PAGES_PER_TASK) -> int:
    """Append the records that no earlier run with this checkpoint has read; tells how many they were."""
    query = (page_stream(spark, path, schema, pages_per_task).writeStream.format("parquet").option("path", target)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)
