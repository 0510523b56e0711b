"""Readers of files and cached records."""

from __future__ import annotations

import difflib
import io
import os
import re
import zipfile
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from weftline.session import prepare


def csv_table(spark: SparkSession, path: str, columns: list[str], schema: str | None = None) -> DataFrame:
    """A catalogue's CSV files with only the named columns; a byte order mark is dropped, gzip is read as is."""
    r = prepare(spark).read.option("header", True).option("multiLine", True).option("escape", '"')
    df = r.schema(schema).csv(path) if schema else r.csv(path)
    return df.toDF(*(c.lstrip("﻿") for c in df.columns)).select(*columns)


def jsonl_last(spark: SparkSession, path: str, schema: str, key: str, order: str | None = None) -> DataFrame:
    """Records of JSON lines, malformed ones skipped; the last record of a key wins, by `order` or by file and place."""
    df = prepare(spark).read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    at = F.col(order) if order else F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    cols = df.columns
    return df.withColumn("_at", at).groupBy(key).agg(F.max_by(F.struct(*cols), "_at").alias("r")).select("r.*")


def newest_series(df: DataFrame, key: str, month: str, run: str) -> DataFrame:
    """Of the series that several runs hold for a key, the one that reaches furthest, then the longest, then the first run."""
    runs = df.groupBy(key, run).agg(F.max(month).alias("_last"), F.count(F.lit(1)).alias("_n"))
    best = runs.groupBy(key).agg(F.min_by(run, F.struct(-F.unix_date(F.col("_last").cast("date")), -F.col("_n"), F.col(run))).alias(run))
    return df.join(best, [key, run], "left_semi")


def missing_jobs(jobs: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    return jobs.join(cache.select(*keys), keys, "left_anti")


def plan_jobs(places: DataFrame, categories: DataFrame) -> DataFrame:
    """Deep places take every category, top places those of level 1; each pair once.
    places (place, kind), categories (category, level): two short lists."""
    pairs = places.crossJoin(F.broadcast(categories))
    return pairs.where("kind = 'deep' or level = 1").select("place", "category").distinct()


def flatten_tree(df: DataFrame, key: str, name: str, children: str) -> DataFrame:
    """(id, name, level, parent) of a two-level tree; an id that repeats keeps its shallowest place."""
    top = df.select(F.col(key).alias("id"), F.col(name).alias("name"), F.lit(1).alias("level"), F.lit(None).cast("string").alias("parent"))
    low = df.select(F.col(key).alias("_p"), F.explode(children).alias("c")).select(F.col(f"c.{key}").alias("id"), F.col(f"c.{name}").alias("name"), F.lit(2).alias("level"), F.col("_p").cast("string").alias("parent"))
    w = Window.partitionBy("id").orderBy("level", "parent")
    return top.unionByName(low).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def inverted_abstract(index: Column) -> Column:
    """Text of a MAP<word, positions>."""
    words = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    return F.array_join(F.transform(F.array_sort(words), lambda s: s["w"]), " ")


def timeline(df: DataFrame, key: str, entries: str) -> DataFrame:
    """(key, month, value): mean by month of nested entries (date, partial, values), partial ones left out."""
    e = df.select(key, F.explode(entries).alias("e")).where("not coalesce(e.partial, false)")
    v = e.select(key, F.trunc(F.col("e.date").cast("date"), "MM").alias("month"), F.explode("e.values").alias("v"))
    return v.groupBy(key, "month").agg(F.avg("v").alias("value"))


def comments_within(df: DataFrame, post: str, position: str, level: str, body: str, budget: int, replies: int = 3) -> DataFrame:
    """Comments of two levels, deleted ones skipped, at most three replies to each, whole comments while they fit the budget."""
    ok = df.where(F.col(body).isNotNull() & ~F.col(body).isin("[deleted]", "[removed]", ""))
    by = Window.partitionBy(post).orderBy(position)
    ok = ok.withColumn("_root", F.sum((F.col(level) == 1).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    ok = ok.withColumn("_k", F.row_number().over(Window.partitionBy(post, "_root", level).orderBy(position))).where((F.col(level) == 1) | (F.col("_k") <= replies))
    ok = ok.withColumn("_u", F.sum(F.length(body) + 1).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return ok.where(F.col("_u") <= budget).drop("_root", "_k", "_u")


class _Main(HTMLParser):
    """Visible lines of a page, and the dates its tags state."""

    SKIP = frozenset(("script", "style", "nav", "footer", "header", "aside", "form"))
    BREAK = frozenset(("p", "div", "br", "li", "h1", "h2", "h3", "h4", "td", "section", "article"))

    def __init__(self) -> None:
        super().__init__()
        self.depth, self.lines, self.now, self.dates = 0, [], [], []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in self.SKIP:
            self.depth += 1
        if tag in self.BREAK:
            self.flush()
        if tag == "meta" and (a.get("property") or a.get("name") or "").lower() in ("article:published_time", "date", "pubdate", "citation_publication_date"):
            self.dates.append(a.get("content") or "")
        if tag == "time" and a.get("datetime"):
            self.dates.append(a["datetime"])

    def handle_endtag(self, tag):
        if tag in self.SKIP and self.depth:
            self.depth -= 1
        if tag in self.BREAK:
            self.flush()

    def handle_data(self, data):
        if not self.depth:
            self.now.append(data)

    def flush(self):
        line = " ".join("".join(self.now).split())
        self.now = []
        if line:
            self.lines.append(line)


def page_text(html: str | None, most: int | None = None, least: int = 40) -> tuple[str, str] | None:
    """(main text, first date) of a page: lines of 40 characters or more, once each; all lines where that leaves under 500 characters. The text is whole unless a limit is given."""
    if not html:
        return None
    p = _Main()
    p.feed(html)
    p.flush()
    once = list(dict.fromkeys(p.lines))
    main = "\n".join(x for x in once if len(x) >= least)
    if len(main) < 500:
        main = "\n".join(once)
    json_date = re.search(r'"datePublished"\s*:\s*"([^"]+)"', html)
    return main[:most], (p.dates or [json_date[1] if json_date else ""])[0]


def page_column(html: Column, most: int | None = None) -> Column:
    """STRUCT(text, date) of each page."""

    def read(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([page_text(x, most) or (None, None) for x in s], columns=["text", "date"])

    return F.pandas_udf(read, "text string, date string")(html)


def cell_rows(data: bytes, sheet: int = 1) -> list[list[str | None]]:
    """Cells of a workbook's sheet as texts, by the spreadsheet's own XML."""
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{ns}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{ns}si")]
        rows = []
        for r in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml")).iter(f"{ns}row"):
            line: list[str | None] = []
            for c in r.iter(f"{ns}c"):
                at = 0
                for ch in re.match(r"[A-Z]+", c.get("r", "A"))[0]:
                    at = at * 26 + ord(ch) - 64
                v = c.find(f"{ns}v")
                text = "".join(t.text or "" for t in c.iter(f"{ns}t")) if c.get("t") == "inlineStr" else None if v is None else v.text
                line += [None] * (at - 1 - len(line))
                line.append(shared[int(text)] if c.get("t") == "s" and text is not None else text)
            rows.append(line)
        return rows


class WorkbookSource(DataSource):
    """spark.read.format("workbook").option("sheet", 1).schema(...).load(path): all cells as texts, the first row is the header."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> StructType:
        with open(self.options["path"], "rb") as f:
            head = cell_rows(f.read(), int(self.options.get("sheet", 1)))[0]
        return StructType([StructField(str(c), StringType()) for c in head])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _WorkbookReader(self.options["path"], int(self.options.get("sheet", 1)), len(schema))


class _WorkbookReader(DataSourceReader):
    def __init__(self, path: str, sheet: int, width: int) -> None:
        self.path, self.sheet, self.width = path, sheet, width

    def partitions(self):
        return [InputPartition(self.path)]

    def read(self, partition):
        with open(partition.value, "rb") as f:
            for row in cell_rows(f.read(), self.sheet)[1:]:
                yield tuple((row + [None] * self.width)[: self.width])


def checked_pool(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A pool written by sinks.write_pool; files that are missing or differ from the manifest are an error."""
    from weftline.sources.sinks import manifest

    said = {(f["path"], f["digest"]) for f in spark.read.json(f"{path}/manifest").first()["files"]}
    have = {(r["path"], r["digest"]) for r in manifest(spark, f"{path}/pool").where("path like '%.csv.gz'").select("path", "digest").collect()}  # one row a file
    if said != have:
        raise ValueError(f"files differ from the manifest: {sorted(p for p, _ in said ^ have)}")
    return prepare(spark).read.schema(schema).option("header", True).csv(f"{path}/pool")


def cached_sheets(spark: SparkSession, book: str, sheets: list[str], cache: str) -> dict[str, DataFrame]:
    """A workbook's sheets as tables, by name in order. They are kept as Parquet under a key of
    the file's size and time, so an unchanged workbook is parsed once."""
    prepare(spark).dataSource.register(WorkbookSource)
    st = os.stat(book)
    folder = f"{cache}/{st.st_size}-{int(st.st_mtime)}"
    out = {}
    for i, name in enumerate(sheets, 1):
        at = f"{folder}/{name}"
        if not os.path.exists(f"{at}/_SUCCESS"):
            spark.read.format("workbook").option("path", book).option("sheet", str(i)).load().write.mode("overwrite").parquet(f"file:{at}")
        out[name] = spark.read.parquet(f"file:{at}")
    return out


def register(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV files with a header, every column as text."""
    return prepare(spark).read.schema(", ".join(f"`{c}` string" for c in columns)).option("header", True).csv(path)


def rising_rows(spark: SparkSession, path: str, categories: DataFrame) -> DataFrame:
    """(geo, cat, query, value, ...) of cached answers (geo, cat, rising), joined to their category
    (cat, ...); answers without a query are left out."""
    raw = prepare(spark).read.schema("geo string, cat string, rising array<struct<query: string, value: bigint>>").json(path)
    return raw.select("geo", "cat", F.explode("rising").alias("r")).select("geo", "cat", "r.*").where("query is not null").join(categories, "cat")


def with_defaults(df: DataFrame, config: DataFrame, key: str, defaults: dict) -> DataFrame:
    """df with the settings its key has in config, or the defaults."""
    x = df.join(config, key, "left")
    return x.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def cached_fetch(wanted: DataFrame, url: str, cache: DataFrame, fetch) -> DataFrame:
    """(url, page, status) of the wanted pages: those in the cache (key: SHA-1 of the address,
    page), and the rest by `fetch`, a Column function that gives null for a failure. Only pages
    fetched belong into the cache."""
    keyed = wanted.withColumn("key", F.sha1(url))
    hit = keyed.join(cache, "key").select(url, "page", F.lit("cached").alias("status"))
    rest = keyed.join(cache, "key", "left_anti").withColumn("page", fetch(F.col(url)))
    return hit.unionByName(rest.select(url, "page", F.when(F.col("page").isNull(), "failed").otherwise("fetched").alias("status")))


def long_years(wide: DataFrame, year: str, value: str) -> DataFrame:
    """Columns named like `2016 (%)` as rows (year, value); all other columns stay."""
    years = [c for c in wide.columns if re.fullmatch(r"\d{4} \(%\)", c)]
    kept = [c for c in wide.columns if c not in years]
    pairs = F.explode(F.array(*(F.struct(F.lit(int(c[:4])).alias(year), F.col(f"`{c}`").cast("double").alias(value)) for c in years))).alias("_y")
    return wide.select(*kept, pairs).select(*kept, "_y.*")


def close_names(typed: DataFrame, value: str, names: DataFrame, name: str, least: float = 0.5, most: int = 5, limit: int = 100_000) -> DataFrame:
    """(value, exact, close): the name a value equals but for case, else the up to five names that
    are most alike, by the share of matching blocks. The list of names is shipped to the
    workers, and must not be longer than `limit`."""
    got = [r[0] for r in names.where(F.col(name).isNotNull()).select(name).distinct().orderBy(name).limit(limit + 1).collect()]
    if len(got) > limit:
        raise ValueError(f"more than {limit} names can't be shipped to all workers")
    lower = {n.lower(): n for n in reversed(got)}

    def look(s: pd.Series) -> pd.DataFrame:
        rows = [(lower.get(v.lower()), [] if v.lower() in lower else difflib.get_close_matches(v, got, n=most, cutoff=least)) for v in s]
        return pd.DataFrame(rows, columns=["exact", "close"])

    return typed.select(value, F.pandas_udf(look, "exact string, close array<string>")(value).alias("r")).select(value, "r.*")


def embedded(texts: DataFrame, text: str, cache: DataFrame, path: str, embed, most_failed: float = 0.1) -> DataFrame:
    """(digest, vector, status) of the distinct texts: cached, embedded or failed. cache (digest, vector)
    lies at path and grows by the new vectors; failures aren't kept. Where more than a part
    of those asked fails, nothing is kept and an error is raised."""
    from weftline.session import cut

    x = texts.select(F.sha2(text, 256).alias("digest"), F.col(text).alias("_t")).dropDuplicates(["digest"])
    hit = cut(x.join(cache, "digest").select("digest", "vector", F.lit("cached").alias("status")))
    new = cut(x.join(cache, "digest", "left_anti").select("digest", embed(F.col("_t")).alias("vector")))
    n, failed = new.agg(F.count(F.lit(1)), F.count(F.when(F.col("vector").isNull(), 1))).first()
    if failed > most_failed * max(n, 1):
        raise RuntimeError(f"{failed} of {n} texts failed")
    new.where("vector is not null").write.mode("append").parquet(path)
    return hit.unionByName(new.select("digest", "vector", F.when(F.col("vector").isNull(), "failed").otherwise("embedded").alias("status")))
