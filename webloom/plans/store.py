"""The crawl store: Parquet folders to which every batch only appends.

``<root>/<table>/run=N/attempt=A`` holds what attempt A of batch N added. It counts once
the batch's row in ``<root>/commit`` names it, which is written last; what a batch
that died left behind is named by none and never read. A page that changes gets a
further row and the latest one counts, so no batch rewrites what earlier ones stored.
HTML lies in a table of its own, by content: the page table that joins and scans
read stays narrow.

Pages lie in folders by the hash of their URL, digests of stored contents in folders by
their own hash (``slot``). A batch looks up its own URLs and digests there and
nothing else: what it costs follows the batch, not the store.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom import schemas
from webloom.operators import tables
from webloom.operators.joins import at_most, hot_key_join, rows_of_keys, slot_of

# Columns as stored. ``part`` splits pages into those visited and the frontier.
LAYOUT: dict[str, str] = {
    "page": "id bigint, site_id bigint, page_type_code string, url string, "
    "html_content_hash bigint, html_sha256 string, http_status_code int, "
    "accessed_time timestamp_ntz, part string, slot int, run int",
    "digest": "html_sha256 string, id bigint, url string, slot int, run int",
    "html": "html_sha256 string, html string, run int",
    "site": "id bigint, domain string, robots_content string, sitemap_content string, run int",
    "sitemap_text": "domain string, part int, sitemap_content string, run int",
    "image": "id bigint, page_id bigint, filename string, content_type string, "
    "data binary, accessed_time timestamp_ntz, run int",
    "page_data": "id bigint, page_id bigint, data_type_code string, data binary, run int",
    "link": "from_page bigint, to_page bigint, run int",
    "repoint": "to_page bigint, new_from bigint, run int",
    "data_type": "code string, run int",
    "page_type": "code string, run int",
    "reject": "url string, reason string, run int",
}
# ``batches``: the last batch of every stream so far; each row takes them over from the one before.
COMMIT = (
    "run int, attempt string, base boolean, rewrites boolean, slots int, tables array<string>, "
    "batches map<string,bigint>, "
    "page_id bigint, site_id bigint, image_id bigint, page_data_id bigint"
)
NUMBERED = ["page", "site", "image", "page_data"]
# Where a page's row lies. Of a page that got another URL a row stays with the old one.
VISITED, FRONTIER, MOVED = "visited", "frontier", "moved"
#: Folders by key hash: more for a larger store, so that a batch's keys touch few of them.
SLOTS = 16


def columns_of(table: str) -> list[str]:
    return [column.split()[0] for column in LAYOUT[table].split(", ")]


# What the state of a page has: without where its row lies.
STATE = ["id", "run", *(c for c in columns_of("page") if c not in ("id", "run", "part", "slot"))]


class CrawlStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._finished: list[T.Row] | None = None

    # ------------------------------------------------------------ runs

    @classmethod
    def create(cls, spark: SparkSession, root: str, slots: int = SLOTS) -> CrawlStore:
        """A store with its seed codes; an existing one is opened as it is, with its own slots."""
        store = cls(spark, root)
        if not store.commits():
            store._empty(slots)
        return store

    @property
    def slots(self) -> int:
        return self.commits()[-1].slots

    def commits(self) -> list[T.Row]:
        """The finished runs since the last reset, oldest first: one short row per batch.

        Kept until this object starts or ends a run; ``refresh`` sees what others did.
        """
        if self._finished is None:
            self._finished = self._read_commits()
        return self._finished

    def refresh(self) -> None:
        self._finished = None

    def _read_commits(self) -> list[T.Row]:
        try:
            rows = self.spark.read.schema(COMMIT).parquet(f"{self.root}/commit").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        rows.sort(key=lambda r: r.run)
        start = max((i for i, r in enumerate(rows) if r.base), default=0)
        return rows[start:]

    def reset(self) -> None:
        """Empty all tables and put the seed codes back. Earlier runs stay on disk, unread."""
        self._empty(self.slots)

    def _empty(self, slots: int) -> None:
        run = Run(self, self._next_run(), slots=slots)
        codes = tables.empty_tables(self.spark)
        for name in ("data_type", "page_type"):
            run.write(name, codes[name])
        run.commit(base=True)

    def _next_run(self) -> int:
        self.refresh()
        done = self.commits()
        return done[-1].run + 1 if done else 0

    def begin(
        self, batch: int | None = None, rewrites: bool = False, stream: str = ""
    ) -> Run | None:
        """The next run; None if ``batch`` of ``stream`` was committed before.

        The batch numbers of one stream rise; those of different streams have nothing to
        do with each other. ``rewrites`` tells that the run may change pages that were
        visited before.
        """
        self.refresh()
        last = self.commits()[-1]
        if batch is not None and batch <= (last.batches or {}).get(stream, -1):
            return None
        done = {} if batch is None else {stream: batch}
        return Run(self, last.run + 1, last, done, rewrites, last.slots)

    # ------------------------------------------------------------ tables

    def log(self, table: str, also: Run | None = None) -> DataFrame:
        """All rows of the committed attempts, and of run ``also`` although it is unfinished.

        The attempts (one per run since the last ``compact``) are named in the filter of the
        scan, so no other folder is read; nobody asks which folders exist.
        """
        done = [(r.run, r.attempt) for r in self.commits() if table in r.tables]
        if also is not None and table in also.tables:
            done.append((also.number, also.attempt))
        return self._attempts(table, done)

    def _attempts(self, table: str, done: list[tuple[int, str]]) -> DataFrame:
        if not done:
            return self.spark.createDataFrame([], LAYOUT[table])
        rows = self.spark.read.schema(LAYOUT[table] + ", attempt string").parquet(
            f"{self.root}/{table}"
        )
        runs, attempts = zip(*done, strict=True)  # an attempt's name is used once
        named = F.col("run").isin(*runs) & F.col("attempt").isin(*attempts)
        return rows.where(named).select(*columns_of(table))

    # ------------------------------------------------------------ lookups

    def pages_of(self, urls: DataFrame, also: Run | None = None) -> DataFrame:
        """The pages of some URLs (``url``) as they are now, in the columns of ``page_state``.

        Reads the folders of these URLs alone and groups no other rows: the latest row of
        a page under that URL counts, unless the page has moved to another.
        """
        found = rows_of_keys(self.log("page", also), urls, "url", self.slots)
        rest = [c for c in columns_of("page") if c not in ("id", "url", "run", "part", "slot")]
        row = F.max(F.struct("run", "part", *rest)).alias("_row")
        latest = found.groupBy("url", "id").agg(row).where(F.col("_row.part") != MOVED)
        return latest.select(*[c if c in ("id", "url") else f"_row.{c}" for c in STATE])

    def originals(self, digests: DataFrame) -> DataFrame:
        """``id, html_sha256`` of the stored pages with one of some contents (``html_sha256``).

        An index of digests, read like the pages. A redirect pass may have given a page new
        content; then the few rows found are compared with the pages as they are.
        """
        found = rows_of_keys(self.log("digest"), digests, "html_sha256", self.slots)
        if not any(r.rewrites for r in self.commits()):
            return found.select("id", "html_sha256")
        current = self.pages_of(found.select("url")).where(F.col("page_type_code") == schemas.HTML)
        return found.select("id", "html_sha256").join(
            current.select("id", "html_sha256"), ["id", "html_sha256"], "left_semi"
        )

    def page_state(self, also: Run | None = None) -> DataFrame:
        """The pages as they are now, without their HTML; ``also`` counts though unfinished."""
        log = self.log("page", also)
        seen = log.where(F.col("part") == VISITED)
        rest = STATE[2:]
        latest = seen.select(*STATE)
        # Only a redirect pass visits a page again. Without one no page has two rows here.
        if any(r.rewrites for r in self.commits()) or (also is not None and also.rewrites):
            row = F.max(F.struct("run", *rest)).alias("_row")
            latest = seen.groupBy("id").agg(row).select("id", "_row.*")
        # A page never goes back to the frontier, so any later row replaces it there.
        waiting = log.where(F.col("part") == FRONTIER).join(seen.select("id"), "id", "left_anti")
        return latest.unionByName(waiting.select(latest.columns))

    def page(self, html: bool = False) -> DataFrame:
        """The page table. Its HTML takes a join; leave it out where it is not needed."""
        state = self.page_state()
        kept = F.col("page_type_code") == schemas.HTML
        body = F.when(
            F.col("page_type_code") == schemas.FRONTIER, F.lit(None).cast("string")
        ).otherwise(F.lit(schemas.NO_HTML))
        if html:
            texts = self.log("html").dropDuplicates(["html_sha256"]).drop("run")
            state = state.join(texts, "html_sha256", "left")
            body = F.when(kept, F.col("html")).otherwise(body)
        else:
            body = F.when(~kept, body)
        return state.withColumn("html_content", body).select(
            schemas.TABLES["page"].fieldNames()
        )

    def frontier(self) -> DataFrame:
        """Pages still to visit: ``id, url`` and the run that found them."""
        log = self.log("page")
        waiting = log.where(F.col("part") == FRONTIER).select("id", "url", "run")
        return waiting.join(log.where(F.col("part") == VISITED).select("id"), "id", "left_anti")

    def link(self) -> DataFrame:
        """The link table with all re-pointed links applied."""
        moved = (
            self.log("repoint")
            .groupBy("to_page")
            .agg(F.max(F.struct("run", "new_from")).alias("_m"))
            .select("to_page", F.col("_m.run").alias("_until"), F.col("_m.new_from"))
        )
        links = hot_key_join(self.log("link"), moved, "to_page", "from_page")
        start = F.when(F.col("run") <= F.col("_until"), F.col("new_from"))
        return links.select(
            F.coalesce(start, F.col("from_page")).alias("from_page"), "to_page"
        ).dropDuplicates()

    def table(self, name: str) -> DataFrame:
        """Any table of the store by name, with its public columns."""
        if name == "page":
            return self.page()
        if name == "link":
            return self.link()
        rows = self.log(name).drop("run")
        return rows.distinct() if name in ("data_type", "page_type") else rows

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in tables.table_names()}

    # ------------------------------------------------------------ single steps

    def add_frontier(self, urls: DataFrame) -> None:
        """Add URLs (``url``) that the store lacks to the frontier."""
        run = self.begin()
        distinct = urls.select("url").distinct()
        rows = tables.new_frontier_rows(distinct, self.pages_of(distinct), run.last.page_id)
        run.write_pages(FRONTIER, rows)
        run.write("page_type", self.spark.createDataFrame([(schemas.FRONTIER,)], "code string"))
        run.commit()

    def compact(self) -> None:
        """Write the tables as they are now into one new run that replaces the earlier ones."""
        run = self.begin()
        state = self.page_state()
        waiting = F.col("page_type_code") == schemas.FRONTIER
        run.write_pages(VISITED, state.where(~waiting | waiting.isNull()))
        run.write_pages(FRONTIER, state.where(waiting))
        run.write_digests(state.where(F.col("page_type_code") == schemas.HTML))
        live = state.where(F.col("html_sha256").isNotNull()).select("html_sha256")
        texts = self.log("html").dropDuplicates(["html_sha256"])
        run.write("html", texts.join(live, "html_sha256", "left_semi"))
        for name in ("site", "image", "page_data", "link", "data_type", "page_type"):
            run.write(name, self.table(name))
        for name in ("sitemap_text", "reject"):
            run.write(name, self.log(name))
        run.commit(base=True, keep_ids=True)


class Run:
    """One attempt at a batch."""

    def __init__(
        self,
        store: CrawlStore,
        number: int,
        last: T.Row | None = None,
        batches: dict[str, int] | None = None,
        rewrites: bool = False,
        slots: int = SLOTS,
    ):
        self.store, self.number, self.attempt = store, number, uuid.uuid4().hex
        self.last, self.batches, self.rewrites = last, batches or {}, rewrites
        self.slots = slots
        self.tables: set[str] = set()

    def _folder(self, table: str) -> str:
        return f"{self.store.root}/{table}/run={self.number}/attempt={self.attempt}"

    def _put(self, df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").parquet(path)

    def write(self, table: str, df: DataFrame) -> None:
        columns = [c for c in columns_of(table) if c not in ("run", "slot")]
        self.tables.add(table)
        self._put(df.select(*columns), self._folder(table))

    def _write_slots(self, df: DataFrame, key: str, path: str) -> None:
        # Spark joins small slots and splits large ones: few files for a small batch, many for a large.
        dealt = df.withColumn("slot", slot_of(key, self.slots)).hint("rebalance", F.col("slot"))
        dealt.write.mode("overwrite").partitionBy("slot").parquet(path)

    def write_pages(self, part: str, df: DataFrame) -> None:
        kinds = dict(column.split() for column in LAYOUT["page"].split(", "))
        columns = [c for c in kinds if c not in ("part", "slot", "run")]
        df = df.select(*[c if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in columns])
        self.tables.add("page")
        self._write_slots(df, "url", f"{self._folder('page')}/part={part}")

    def write_digests(self, df: DataFrame) -> None:
        """The contents of stored pages (``html_sha256, id, url``)."""
        rows = df.where(F.col("html_sha256").isNotNull()).select("html_sha256", "id", "url")
        self.tables.add("digest")
        self._write_slots(rows, "html_sha256", self._folder("digest"))

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written next to the store and read back: computed once, safe if executors go."""
        path = f"{self._folder('stage')}/{name}"
        self._put(df, path)
        return self.store.spark.read.schema(df.schema).parquet(path)

    def stage_slots(self, name: str, df: DataFrame, key: str) -> DataFrame:
        """As ``stage``, clustered by the hash of ``key`` in folders (column ``slot``)."""
        path = f"{self._folder('stage')}/{name}"
        self._write_slots(df, key, path)
        schema = T.StructType([*df.schema, T.StructField("slot", T.IntegerType())])
        return self.store.spark.read.schema(schema).parquet(path)

    def stage_counted(self, name: str, df: DataFrame) -> DataFrame:
        """As ``stage``; joins learn how many rows there are, and that no key can be hot."""
        staged = self.stage(name, df)
        return at_most(staged, staged.count())

    def read(self, table: str) -> DataFrame:
        """What this run has written to a table so far."""
        return self.store._attempts(table, [(self.number, self.attempt)] if table in self.tables else [])

    def commit(self, base: bool = False, keep_ids: bool = False) -> None:
        kept = self.last is not None and (keep_ids or not base)
        before = {t: getattr(self.last, f"{t}_id") if kept else 0 for t in NUMBERED}
        read = [self.read(t).select(F.lit(t).alias("t"), "id") for t in NUMBERED if t in self.tables]
        ids = before
        if read:
            highest = reduce(DataFrame.unionByName, read).groupBy("t").agg(F.max("id").alias("id"))
            ids = before | {r.t: max(before[r.t], r.id or 0) for r in highest.collect()}
        batches = {**(self.last.batches or {} if kept else {}), **self.batches}
        state = (self.number, self.attempt, base, self.rewrites, self.slots, sorted(self.tables))
        row = (*state, batches, *(ids[t] for t in NUMBERED))
        self._put(
            self.store.spark.createDataFrame([row], COMMIT).coalesce(1),
            f"{self.store.root}/commit/run={self.number}",
        )
        self.store.refresh()
