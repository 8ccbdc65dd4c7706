"""Readers: documents with a header, JSON lines, registries."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgraph.functions import text, yaml
from docgraph.plans import once


def _scalar(raw: Column) -> Column:
    """A header value without quotes and remarks; the null spellings become null."""
    quoted = r"^\s*(['\"])(.*)\1\s*(?:#.*)?$"
    bare = F.trim(F.regexp_replace(raw, r"(?:^|\s+)#.*$", ""))
    bare = F.when(bare.isin("null", "[]", "{}"), None).otherwise(bare)
    inner = F.replace(F.regexp_extract(raw, quoted, 2), F.lit("''"), F.lit("'"))
    return text.blank_to_null(F.when(raw.rlike(quoted), inner).otherwise(bare))


def _typed(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.try_to_date(F.substring(value, 1, 10), "yyyy-MM-dd")
    if isinstance(kind, T.TimestampType):
        return text.timestamp(value)
    if isinstance(kind, T.StringType):
        return value
    return value.try_cast(kind)


def _block(header: Column, name: str) -> Column:
    """The indented lines below ``name:``, or the list items below it."""
    return F.regexp_extract(header, rf"(?m)^{name}:[ \t]*(?:#.*)?\n((?:(?:[ \t]+.*|-[ \t].*|[ \t]*)\n?)+)", 1)


def _field(header: Column, field: T.StructField, indent: str = "") -> Column:
    name = "\\Q" + field.name + "\\E"
    kind = field.dataType
    inline = F.regexp_extract(header, rf"(?m)^{indent}{name}:[ \t]+([^\n]*)$", 1)
    if isinstance(kind, T.StructType):
        block = _block(header, name)
        inner = F.struct(*[_field(block, f, r"[ \t]+").alias(f.name) for f in kind.fields])
        return F.when(block != "", inner)
    if isinstance(kind, T.ArrayType):
        listed = F.regexp_extract_all(_block(header, name),
                                      F.lit(r"(?m)^[ \t]*-[ \t]+([^\n]*)$"), F.lit(1))
        flow = F.split(F.regexp_extract(inline, r"^\[(.*)\]", 1), ",")
        items = F.when(F.size(listed) > 0, listed).when(inline.startswith("["), flow).when(
            _scalar(inline).isNotNull(), F.array(inline)).otherwise(F.array().cast("array<string>"))
        values = F.transform(items, lambda x: _typed(_scalar(x), kind.elementType))
        return F.filter(values, lambda x: x.isNotNull())
    return _typed(_scalar(inline), kind)


def parse_documents(df: DataFrame, schema: T.StructType, column: str = "value",
                    required: tuple[str, ...] = ("title",)) -> tuple[DataFrame, DataFrame]:
    """Split header and body into the columns of ``schema``; rows that do not fit stay apart.

    The second frame holds the rows without a header or without a required field, with reason.
    """
    raw = F.col(column)
    whole = F.when(F.contains(raw, F.lit("\r")), F.regexp_replace(raw, "\r\n?", "\n")).otherwise(raw)
    # The header and its fences; what follows them is the body.
    fenced = F.regexp_extract(whole, r"^\x{FEFF}?---\n(?s:.*?\n)---(?:\n|$)", 0)
    header = F.regexp_extract(fenced, r"^\x{FEFF}?---\n((?s:.*\n))---", 1)
    body = F.substring(whole, F.length(fenced) + 1, F.length(whole))
    rows = once.computed(df, {"_header": header, "body": body})
    rows = once.computed(rows, {f.name: _field(F.col("_header"), f) for f in schema.fields})
    lacking = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in required]))
    reason = F.when(F.col("_header") == "", "no header").when(
        F.size(lacking) > 0, F.concat(F.lit("missing: "), F.concat_ws(", ", lacking)))
    rows = rows.withColumn("_reason", reason)
    keep = [c for c in df.columns if c != column]
    good = rows.filter("_reason is null").select(*keep, *[f.name for f in schema.fields], "body")
    bad = rows.filter("_reason is not null").select(
        *keep, F.col("_reason").alias("reason"), F.col(column))
    return good, bad


def documents(spark: SparkSession, path: str, schema: T.StructType,
              required: tuple[str, ...] = ("title",)) -> tuple[DataFrame, DataFrame]:
    """Read a folder of header-and-body files, one row per file.

    Spark leaves out files whose names begin with ``_``; give such files another name first.
    Land the result once as Parquet: small files cost more than their content.
    """
    raw = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_name"))
    return parse_documents(raw, schema, "value", required)


def records(df: DataFrame, schema: T.StructType, column: str = "value",
            required: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Type texts in plain YAML, one record or registry each; maps and lists as the schema says.

    The second frame holds the texts that could not be read or lack a required field, with reason.
    """
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    rows = once.computed(df, {"_yaml": yaml.to_json(F.col(column))})
    rows = once.computed(rows, {"_row": F.from_json("_yaml.json", full, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})})
    lacking = F.array_compact(F.array(*[F.when(F.col("_row")[c].isNull(), c) for c in required]))
    shape = F.col("_row").isNull() | F.col("_row._corrupt").isNotNull() | ~F.col("_yaml.json").startswith("{")
    rows = rows.withColumn("_reason", F.coalesce(
        F.when(F.trim(F.coalesce(column, F.lit(""))) == "", "empty"), "_yaml.reason", F.when(shape, "not of the schema"),
        F.when(F.size(lacking) > 0, F.concat(F.lit("missing: "), F.concat_ws(", ", lacking)))))
    keep = [c for c in df.columns if c != column]
    good = rows.filter("_reason is null").select(*keep, *[F.col("_row")[f.name].alias(f.name) for f in schema.fields])
    return good, rows.filter("_reason is not null").select(*keep, F.col("_reason").alias("reason"), column)


def jsonl(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Read JSON lines with a fixed schema; unreadable lines stay apart."""
    lines = spark.read.text(path)
    return json_column(lines, "value", schema)


def json_column(df: DataFrame, column: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Type a JSON text column; the second frame holds the texts that do not parse."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(column, full, {"mode": "PERMISSIVE",
                                        "columnNameOfCorruptRecord": "_corrupt"})
    rows = df.withColumn("_row", parsed)
    broken = F.col("_row").isNull() | F.col("_row._corrupt").isNotNull()
    keep = [c for c in df.columns if c != column]
    good = rows.filter(~broken).select(*keep, *[F.col("_row")[f.name].alias(f.name)
                                                for f in schema.fields])
    return good, rows.filter(broken).select(*keep, column)


def registry(df: DataFrame, key: str, aliases: str = "aliases") -> DataFrame:
    """One row per alias of a registry, with the number of entries that claim the alias."""
    flat = (df.select(key, F.explode_outer(aliases).alias("alias"))
            .withColumn("alias", text.blank_to_null("alias")).distinct())
    owners = (flat.filter("alias is not null").groupBy("alias")
              .agg(F.count(F.lit(1)).alias("owners")))
    return flat.join(owners, "alias", "left").select(
        key, "alias", F.coalesce("owners", F.lit(0)).alias("owners"))


def markup(df: DataFrame, column: str) -> DataFrame:
    """Header facts of a web page: title, language, number of links."""
    html = F.col(column)
    return df.withColumns({
        "title": F.trim(F.regexp_extract(html, r"<title>([^<]*)</title>", 1)),
        "lang": F.regexp_extract(html, r'<html lang="([a-z]+)"', 1),
        "n_links": F.regexp_count(html, F.lit('<a href="')).cast("long"),
    })
