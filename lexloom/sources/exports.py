"""Exports: workbooks, archives, sitemaps, registries, indexes, artifact sets; each from an ordered DataFrame, row by row."""

from __future__ import annotations

import io
import json
import tarfile
import urllib.parse
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks, storage

#: The parts of a workbook, and its names.
_NS = "http://schemas.openxmlformats.org"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def _xml(x: object) -> str:
    text = "" if x is None else str(x)
    text = text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")
    # characters that XML has no way to write
    return "".join(c for c in text if c >= " " or c in "\t\n\r")


def _column(i: int) -> str:
    name = ""
    while True:
        name, i = chr(65 + i % 26) + name, i // 26 - 1
        if i < 0:
            return name


def _sheet(df: DataFrame) -> Iterator[str]:
    yield f'{_HEAD}<worksheet xmlns="{_NS}/spreadsheetml/2006/main"><sheetData>'
    rows = (list(r) for r in df.toLocalIterator())
    for n, row in enumerate([df.columns], 1):
        yield _row(n, row)
    for n, row in enumerate(rows, 2):
        yield _row(n, row)
    yield "</sheetData></worksheet>"


def _row(n: int, values: list) -> str:
    cells = []
    for i, v in enumerate(values):
        at = f"{_column(i)}{n}"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            cells.append(f'<c r="{at}"><v>{v}</v></c>')
        else:
            cells.append(f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{_xml(v)}</t></is></c>')
    return f'<row r="{n}">{"".join(cells)}</row>'


def workbook(spark: SparkSession, sheets: dict[str, DataFrame], path: str) -> int:
    """A workbook with a sheet for each DataFrame, in its order; rows are read one partition at a time."""
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        numbers = range(1, len(sheets) + 1)
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in numbers)
        z.writestr(
            "[Content_Types].xml",
            f'{_HEAD}<Types xmlns="{_NS}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>',
        )
        kind = f"{_NS}/officeDocument/2006/relationships"
        z.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{_NS}/package/2006/relationships"><Relationship Id="rId1" Type="{kind}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{kind}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers)
        z.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_NS}/package/2006/relationships">{links}</Relationships>')
        names = "".join(f'<sheet name="{_xml(name)}" sheetId="{i}" r:id="rId{i}"/>' for i, name in zip(numbers, sheets))
        z.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_NS}/spreadsheetml/2006/main" xmlns:r="{kind}"><sheets>{names}</sheets></workbook>')
        for i, df in zip(numbers, sheets.values()):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as out:
                for piece in _sheet(df):
                    out.write(piece.encode())
    return storage.put(spark, path, held.getvalue())


def archive(spark: SparkSession, folder: str, path: str) -> int:
    """The files below ``folder`` as a gzipped tar, names in order, times zero; a file at a time."""
    held = io.BytesIO()
    root = folder.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    with tarfile.open(fileobj=held, mode="w:gz") as tar:
        for r in files.select("path", "content").orderBy("path").toLocalIterator():
            info = tarfile.TarInfo(r.path.split(root.split(":")[-1].rstrip("/") + "/", 1)[-1])
            info.size = len(r.content)
            tar.addfile(info, io.BytesIO(bytes(r.content)))
    return storage.put(spark, path, held.getvalue())


def byte_totals(spark: SparkSession, path: str) -> DataFrame:
    """(folder, files, bytes): totals of each folder below ``path``, and of all as a null folder."""
    files = sinks.checksums(spark, path)
    return files.rollup(F.element_at(F.split("path", "/"), -2).alias("folder")).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def frozen(spark: SparkSession, path: str, baseline: DataFrame) -> DataFrame:
    """(name, problem): files that a baseline (name, bytes, sha256) has otherwise, or only one side has."""
    now = sinks.checksums(spark, path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("bytes").alias("b"), F.col("sha256").alias("h"))
    both = baseline.join(now, "name", "full_outer")
    problem = F.when(F.col("h").isNull(), "missing").when(F.col("sha256").isNull(), "new").when((F.col("b") != F.col("bytes")) | (F.col("h") != F.col("sha256")), "changed")
    return both.select("name", problem.alias("problem")).where("problem IS NOT NULL")


def manifest(spark: SparkSession, path: str, parts: dict[str, str]) -> dict:
    """What a build is made of: its id from ``parts`` and its files, and those files; they are tens."""
    files = [r.asDict() for r in sinks.checksums(spark, path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "bytes", "sha256").orderBy("name").collect()]
    return {"build_id": sinks.build_id(parts | {f["name"]: f["sha256"] for f in files}), "files": files}


def document(spark: SparkSession, value: object, path: str) -> int:
    """One JSON document, indented, with a line end."""
    return storage.put(spark, path, json.dumps(value, ensure_ascii=False, indent=2) + "\n")


def lines(spark: SparkSession, df: DataFrame, path: str) -> int:
    """The rows of ``df`` in order as one file of JSON lines; no rows give one empty line."""

    def rows() -> Iterator[bytes]:
        some = False
        for r in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("x")).toLocalIterator():
            some = True
            yield r.x.encode() + b"\n"
        if not some:
            yield b"\n"

    return storage.put(spark, path, rows())


def sitemap(spark: SparkSession, df: DataFrame, id: str, path: str, most: int = 5000, base: str = "/tu/") -> int:
    """The first ``most`` ids of an ordered index as a sitemap."""
    rows = [f"  <url><loc>{base}{urllib.parse.quote(str(r[0]), safe=chr(33) + '~*()' + chr(39))}</loc></url>" for r in df.select(id).limit(most).collect()]
    text = "\n".join(['<?xml version="1.0" encoding="UTF-8"?>', '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">', *rows, "</urlset>"]) + "\n"
    return storage.put(spark, path, text)


def registry_files(spark: SparkSession, sources: DataFrame, folder: str) -> None:
    """The source registry as a report and as a document."""
    storage.put(spark, f"{folder}/sources.md", "# Sources\n\n" + sinks.markdown(sources.orderBy("key")))
    document(spark, [r.asDict() for r in sources.orderBy("key").collect()], f"{folder}/source-registry.json")  # tens of rows


def shards(df: DataFrame, path: str, shard: str = "shard") -> DataFrame:
    """Index rows in a folder for each shard; returns their numbers."""
    df.write.mode("overwrite").partitionBy(shard).json(path)
    return df.groupBy(shard).agg(F.count("*").alias("n"))


def artifacts(spark: SparkSession, parts: dict[str, DataFrame], order: dict[str, list[Column]], folder: str, sample: int = 100) -> dict[str, int]:
    """Each part as JSON lines in its order, a sample of its first rows, and a summary of their numbers."""
    sizes = {}
    for name, df in parts.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")
        sizes[name] = spark.read.schema(df.schema).json(f"{folder}/{name}").count()
        sinks.head(df, order[name], sample, f"{folder}/{name}-sample")
    document(spark, sizes, f"{folder}/summary.json")
    return sizes
