"""CSV files with a header row: columns by name, whatever order and encoding each file has."""

import csv
from collections import defaultdict
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Byte order marks at the start of a file.
UTF16_MARKS = ("FFFE", "FEFF")
# What SQL engines write: quotes inside a value are doubled, blanks are kept.
DIALECT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def quotes_in(text):
    """Number of quotes, counted in bytes, as the text may be in any one-byte encoding."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))


def describe_files(spark: SparkSession, path) -> DataFrame:
    """(file, encoding, header, multi_line) per file.

    UTF-16 by its mark, else UTF-8 if every line is valid UTF-8, else ISO-8859-1 (which
    any bytes satisfy). `header` is the first line's bytes; `multi_line` tells that some
    line has an odd number of quotes, so that a value goes on in the next. Reads the files
    as raw lines, split and aggregated like any text scan; no file is loaded whole.
    """
    quotes = quotes_in("value")
    first = F.col("_metadata.file_block_start") == 0
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.is_valid_utf8("value").alias("valid"),
        (quotes % 2 == 1).alias("odd"),
        F.when(first, F.monotonically_increasing_id()).alias("number"),
        F.col("value").cast("binary").alias("line"),
    )
    files = lines.groupBy("file").agg(
        F.bool_and("valid").alias("valid"),
        F.bool_or("odd").alias("odd"),
        F.min_by("line", "number").alias("header"),
    )
    marked = F.hex(F.substring("header", 1, 2)).isin(*UTF16_MARKS)
    encoding = F.when(marked, "UTF-16").when(F.col("valid"), "UTF-8").otherwise("ISO-8859-1")
    return files.select("file", encoding.alias("encoding"), "header", F.col("odd").alias("multi_line"))


def header_names(header, encoding):
    """Column names of a first line."""
    if encoding.upper().startswith("UTF-16"):
        # Cut at the byte of the line end, whose other byte may be left.
        text = header[: len(header) // 2 * 2].decode(encoding)
    else:
        text = header.decode("utf-8-sig" if encoding.upper() == "UTF-8" else encoding)
    return next(csv.reader([text.rstrip("\r")]), [])


def read_csv(spark: SparkSession, path, schema, encoding=None, multi_line=None) -> DataFrame:
    """The columns of `schema` (DDL text or a type) by name; other columns are ignored.

    A file without one of the columns is an error. Files that agree in encoding, header
    and line ends are read together; if all do, by `path` itself, otherwise by their
    names, which Spark lists on the driver as well. Line ends inside values are found by
    counting quotes, split by split; only two-byte files are one task's work each.
    `encoding` overrides what the files look like; with `multi_line` as well nothing is
    looked at but the first line, which all files then share.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if encoding and multi_line is not None:
        first = _lines(spark, path).where("split = 0").select("line").first()
        return _read(spark, path, wanted, encoding, first.line, multi_line) if first else spark.createDataFrame([], wanted)
    described = describe_files(spark, path)
    if encoding:
        described = described.withColumn("encoding", F.lit(encoding))
    kinds = described.groupBy("encoding", "header", "multi_line").count().limit(2).collect()
    if not kinds:
        return spark.createDataFrame([], wanted)
    if len(kinds) == 1:
        groups = {tuple(kinds[0])[:3]: path}
    else:
        groups = defaultdict(list)
        for row in described.collect():
            # Spark reports names in their escaped form.
            groups[row["encoding"], bytes(row["header"]), row["multi_line"]].append(unquote(row["file"]))
    order = sorted(groups, key=lambda g: (g[0], bytes(g[1]), g[2]))
    parts = [_read(spark, groups[group], wanted, *group) for group in order]
    return reduce(DataFrame.unionByName, parts)


def _read(spark, paths, wanted, encoding, header, multi_line):
    names = header_names(bytes(header), encoding)
    missing = [f.name for f in wanted.fields if f.name not in names]
    if missing:
        raise ValueError(f"no column {missing} among {names}")
    kinds = {f.name: f.dataType for f in wanted.fields}
    # Columns that are not wanted may repeat a name.
    inside = T.StructType([
        T.StructField(name, kinds[name])
        if name in kinds and names.index(name) == i
        else T.StructField(f"_{i}", T.StringType())
        for i, name in enumerate(names)
    ])
    chosen = [f.name for f in wanted.fields]
    if multi_line and not encoding.upper().startswith("UTF-16"):
        parsed = F.from_csv("record", inside.simpleString(), {k: str(v).lower() for k, v in DIALECT.items()} | {"header": "false"})
        return whole_records(spark, paths, encoding).select(parsed.alias("r")).select(*[f"r.`{c}`" for c in chosen])
    reader = spark.read.schema(inside).options(**DIALECT).option("encoding", encoding)
    # Only the multi-line reader finds line ends in two-byte text.
    if encoding.upper().startswith("UTF-16"):
        reader = reader.option("multiLine", True)
    return reader.csv(paths).select(*chosen)


def _lines(spark, paths):
    """Raw lines (split at \\n only) with the file and the first byte of their split."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("line"),
    )


def whole_records(spark, paths, encoding="UTF-8") -> DataFrame:
    """(record): the text of every record but the headers; values may hold line ends.

    A line end belongs to a value if an odd number of quotes stands before it. Each split
    counts its quotes; the parities of a file's splits, added up in order, tell every split
    whether it begins inside a value, so all splits of a file are read by tasks of their
    own. Only the lines of records that go over several lines are brought together. Quotes
    are taken to be written as `DIALECT` says: around values, and doubled inside them.
    """
    lines = _lines(spark, paths)
    odd = lines.groupBy("file", "split").agg((F.sum(quotes_in(F.col("line").cast("string"))) % 2).alias("odd"))
    # One row per split, as the driver lists them when it plans the scan.
    opened, before = {}, {}
    for row in odd.orderBy("file", "split").collect():
        opened[row.file, row.split] = before.get(row.file, 0)
        before[row.file] = (before.get(row.file, 0) + row.odd) % 2
    codec = "utf-8-sig" if encoding.upper() == "UTF-8" else encoding

    def pieces(batches):
        """Whole records, and pieces of those that go over several lines, with their place."""
        here, inside, number = None, 0, 0
        for batch in batches:
            out = []
            for file, split, line in zip(*(batch.column(c).to_pylist() for c in ("file", "split", "line"))):
                if (file, split) != here:
                    here, number = (file, split), 0
                    inside = opened[here]
                    first = split == 0
                number += 1
                began, inside = inside, (inside + line.count(b'"')) % 2
                head, first = first, first and bool(inside)
                if not began and not inside:
                    if not head:
                        out.append((line.decode(codec).removesuffix("\r"), file, None, None, None))
                else:
                    # A header over several lines begins in the first split, before line 1.
                    out.append((line.decode(codec), file, split, number, not began))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["text", "file", "split", "number", "starts"]
            )

    made = lines.mapInArrow(pieces, "text STRING, file STRING, split LONG, number LONG, starts BOOLEAN")
    whole = made.where("split IS NULL").select(F.col("text").alias("record"))
    order = Window.partitionBy("file").orderBy("split", "number")
    parts = made.where("split IS NOT NULL").withColumn("record_no", F.sum(F.col("starts").cast("long")).over(order))
    joined = parts.groupBy("file", "record_no").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("split", "number", "text"))), lambda p: p.text), "\n").alias("record"),
        F.min(F.struct("split", "number")).alias("at"),
    )
    # The header is the record that begins with the first line of a file.
    rest = joined.where("at.split > 0 OR at.number > 1").select(F.regexp_replace("record", "\r$", "").alias("record"))
    return whole.where("record <> ''").unionByName(rest)
