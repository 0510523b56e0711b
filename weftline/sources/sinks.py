"""Writers: closed schemas, a star schema, manifests."""

from __future__ import annotations

import hashlib
import io
import re
import sqlite3
import uuid
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def closed(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with exactly these columns in this order; others are an error."""
    if extra := sorted(set(df.columns) - set(columns)):
        raise ValueError(f"unknown columns: {extra}")
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns))


def write_csv(df: DataFrame, path: str, columns: list[str], gzip: bool = False) -> None:
    closed(df, columns).write.mode("overwrite").option("header", True).option("compression", "gzip" if gzip else "none").csv(path)


def write_star(tables: dict[str, DataFrame], path: str, partitions: dict[str, list[str]] | None = None) -> None:
    """A folder of Parquet for each table; the commit protocol makes each overwrite whole."""
    for name, df in tables.items():
        w = df.write.mode("overwrite").option("compression", "zstd")
        (w.partitionBy(*partitions[name]) if partitions and name in partitions else w).parquet(f"{path}/{name}")


def write_sqlite(tables: dict[str, DataFrame], path: str, most: int = 5_000_000) -> None:
    """A small database for hand-over; a table of more than `most` rows is refused."""
    with sqlite3.connect(path) as con:
        for name, df in tables.items():
            if df.limit(most + 1).count() > most:
                raise ValueError(f"{name} has more than {most} rows")
            kinds = ", ".join(f'"{c}" {"INTEGER" if t in ("int", "bigint", "boolean", "smallint") else "REAL" if t in ("double", "float") else "TEXT"}' for c, t in df.dtypes)
            con.execute(f'DROP TABLE IF EXISTS "{name}"')
            con.execute(f'CREATE TABLE "{name}" ({kinds})')
            rows = ([v if v is None or isinstance(v, (int, float, str)) else str(v) for v in r] for r in df.toLocalIterator())
            con.executemany(f'INSERT INTO "{name}" VALUES ({", ".join("?" * len(df.columns))})', rows)


def compact_json(*cols: Column) -> Column:
    """JSON of the columns without null fields; 0 and false stay."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "true"})


def flat(df: DataFrame, most: int | None = None) -> DataFrame:
    """Lists joined by a bar, structures as JSON; texts cut to `most` characters only where a limit
    is given, as for the cells of a spreadsheet."""
    out = []
    for c, t in df.dtypes:
        x = F.array_join(F.col(c).cast("array<string>"), " | ") if t.startswith("array<") and "struct" not in t else F.to_json(c) if t.startswith(("struct", "map", "array<struct")) else F.col(c)
        text = t == "string" or t.startswith(("array", "struct", "map"))
        out.append((F.substring(x, 1, most) if text and most else x).alias(c))
    return df.select(*out)


def latest(log: DataFrame, key: str, order: str) -> DataFrame:
    """The last record of each key of an append-only log."""
    return log.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))).where("_r = 1").drop("_r")


def _digests(paths: pd.Series) -> pd.Series:
    """SHA-256 of each file, read in pieces of a megabyte."""
    from pyarrow.fs import FileSystem

    out = []
    for p in paths:
        fs, at = FileSystem.from_uri(p)
        h = hashlib.sha256()
        with fs.open_input_stream(at) as f:
            while piece := f.read(1 << 20):
                h.update(piece)
        out.append(h.hexdigest())
    return pd.Series(out)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, digest) of the files of a folder. Files are listed without their contents and
    digested in pieces, so a file may be of any size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    uri = F.regexp_replace("path", "^file:/+", "file:///")
    return files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("path"), F.col("length").alias("bytes"), F.pandas_udf(_digests, "string")(uri).alias("digest"))


def stale_inputs(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Inputs whose digest differs from the one their producer wrote."""
    o = outputs.select("path", F.col("digest").alias("_d"))
    return inputs.join(o, "path").where("digest != _d").drop("_d")


def write_pool(pool: DataFrame, path: str, columns: list[str]) -> None:
    """A pool of series as gzip CSV files with a manifest: rows, keywords, months and each file's digest."""
    write_csv(pool, f"{path}/pool", columns, gzip=True)
    files = manifest(pool.sparkSession, f"{path}/pool").where("path like '%.csv.gz'")
    facts = pool.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("keyword").alias("n_keywords"), F.min("month").alias("first_month"), F.max("month").alias("last_month"))
    listed = files.agg(F.sort_array(F.collect_list(F.struct("path", "digest"))).alias("files"))  # one row a file
    facts.crossJoin(listed).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")  # one row each


def replace_whole(df: DataFrame, path: str) -> None:
    """Write df beside `path`, then put it in its place by a rename, so that readers see the old rows or the new ones."""
    spark = df.sparkSession
    fresh = f"{path}.{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(at, True)
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(fresh), at):
        raise OSError(f"{fresh} could not be renamed")


_BAD_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def _cell(at: str, value: str | None) -> str:
    return "" if value is None else f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(_BAD_XML.sub("", value))}</t></is></c>'


def _letters(n: int) -> str:
    out = ""
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def workbook_bytes(sheets: dict[str, list[list[str | None]]]) -> bytes:
    """A workbook with a sheet for each entry; all cells are texts."""
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        names = "".join(f'<sheet name="{escape(n[:31])}" sheetId="{i}" r:id="s{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}/relationships">' + "".join(f'<Relationship Id="s{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        for i, rows in enumerate(sheets.values(), 1):
            lines = "".join(f'<row r="{y}">{"".join(_cell(f"{_letters(x)}{y}", v) for x, v in enumerate(r, 1))}</row>' for y, r in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{lines}</sheetData></worksheet>')
    return out.getvalue()


def write_workbook(tables: dict[str, DataFrame], path: str, most: int = 1_000_000) -> None:
    """A workbook for hand-over, a sheet a table; a table of more rows than a sheet holds is refused."""
    import os

    sheets = {}
    for name, df in tables.items():
        if df.limit(most + 1).count() > most:
            raise ValueError(f"{name} has more than {most} rows")
        sheets[name] = [df.columns, *([None if v is None else str(v) for v in r] for r in df.toLocalIterator())]
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(workbook_bytes(sheets))
