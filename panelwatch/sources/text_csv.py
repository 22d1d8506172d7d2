"""CSV files as tables of strings, parsed by Spark's own reader in one pass and without loss.

Within a quoted field two quotes stand for one, and line breaks and separators are text; elsewhere a quote is
a character. A file is parsed by one task, many files by many. What the reader would let pass is checked
behind it: records with too many fields, a quoted field that a file does not end, and headers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.operators.lookup import lookup
from panelwatch.session import materialise

_RAW = "_raw"
_FORMAT = {
    "header": False,
    "multiLine": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _RAW,
}

# The grammar of a record's text. All repeats are possessive: a field can be read in one way only.
_INNER = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_INNER}"[^,]*+|[^",][^,]*+)'
_OPENS = rf'\A(?:{_FIELD}?,)*+"{_INNER}\z'


def field_count(record: Column) -> Column:
    """Fields of a CSV record: the separators between fields, plus one."""
    return F.length(F.regexp_replace(record, _FIELD, "")) + 1


def _read(spark: SparkSession, path: str, n: int) -> DataFrame:
    """All records but blank lines as c0, c1, … and, unless a record has just `n` fields, its text."""
    schema = ", ".join([*[f"c{i} string" for i in range(n)], f"{_RAW} string"])
    records = spark.read.schema(schema).options(**_FORMAT).csv(path)
    text = F.col(_RAW) if n > 1 else F.coalesce(_RAW, "c0")
    return records.where(F.coalesce(F.rtrim(text, F.lit("\r\n")) != "", F.lit(True)))


def _parsed(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """`file, place, fields, fault` of every record, written, and how many fields a record has.

    The reader is told of one field more than there are, so that it hands over the text of every record;
    the checks need it. Places rise within a file.
    """
    first = _read(spark, path, 1).select("c0", field_count(F.col(_RAW))).first()
    if first is None:
        raise ValueError(f"no header in {path}")
    n = first[1] or 1
    raw = F.col(_RAW)
    separators = F.length(raw) - F.length(F.replace(raw, F.lit(","), F.lit("")))
    # With a text there are more or fewer fields than n + 1; without one there are just as many.
    long = raw.isNull() | ((separators >= n) & (field_count(raw) > n))
    opens = F.contains(raw, F.lit('"')) & raw.rlike(_OPENS)
    text = F.coalesce(raw, F.array_join(F.array(*[f"c{i}" for i in range(n + 1)]), ",", ""))
    fault = F.when(opens, F.concat(F.lit("a quoted field does not end in "), F.col("file"))).when(
        long, F.concat(F.lit(f"more than {n} fields: "), text)
    )
    fields = F.array(*[F.coalesce(F.col(f"c{i}"), F.lit("")) for i in range(n)])
    records = _read(spark, path, n + 1).withColumn("file", F.col("_metadata.file_path"))
    checked = records.select("file", F.monotonically_increasing_id().alias("place"), fields.alias("fields"), fault.alias("fault"))
    return materialise(checked, "csv_records"), n


def _names(fields: Column) -> Column:
    """The names in a header; a missing one is called by its place, a repeated one by its number."""
    told = F.transform(fields, lambda name, i: F.when(name == "", F.concat(F.lit("_c"), i.cast("string"))).otherwise(name))

    def numbered(name: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(told, F.lit(1), i), lambda other: other == name))
        return F.when(before > 0, F.concat(name, F.lit("."), before.cast("string"))).otherwise(name)

    return F.transform(told, numbered)


def parse_text_csv(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """`read_text_csv`, and the number of records that were parsed."""
    records, n = _parsed(spark, path)
    firsts = records.groupBy("file").agg(F.min("place").alias("place"))
    # One row per file.
    heads = materialise(
        lookup(records, materialise(firsts.select("place"), "header_places"), ["place"])
        .select("file", F.col("place").alias("head"), _names(F.col("fields")).alias("names"), "fault"),
        "headers",
    )
    names = heads.orderBy("file").first()["names"]
    expected = F.array(*map(F.lit, names))
    others = heads.where((F.array_sort("names") != F.array_sort(expected)) | F.startswith("fault", F.lit("more than")))
    other = others.orderBy("file").first()
    if other is not None:
        raise ValueError(f"headers differ below {path}: {names} and {other['fault'] or other['names']}")

    places = F.transform(expected, lambda name: (F.array_position("names", name) - 1).cast("int"))
    told = lookup(records, heads.select("file", "head", places.alias("places")), ["file"], salt_by=["place"])
    # A filter, so it holds whichever columns are read.
    whole = F.coalesce(F.when(F.col("fault").isNotNull(), F.raise_error(F.col("fault")).cast("boolean")), F.lit(True))
    rows = told.where((F.col("place") > F.col("head")) | F.startswith("fault", F.lit("a quoted"))).where(whole)
    values = [F.get("fields", F.get("places", F.lit(i))).alias(name) for i, name in enumerate(names)]
    return rows.select(*values), records.count() - heads.count()


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column a string, under the header's names, with '' for empty.

    A byte order mark is dropped and undecodable bytes are replaced. Rows shorter than the header are
    filled with ''. The job fails on a longer row, and on a quoted field that a file does not end. Every
    file has a header of its own; files with the same names in another order are aligned by name, and
    other names are an error, however many headers there are. Names are in the order of the file whose path
    is least. In a file whose first line ends with a carriage return and a line feed, that pair within quotes is read
    as a line feed.
    """
    return parse_text_csv(spark, path)[0]
