"""Landed API replies: JSON documents whose row list hides under varying keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tutorlake.functions.jsonfields import accept_repeated_keys, is_string, node_at, path, staged, text_at
from tutorlake.operators.totals import total_before
from tutorlake.session import stored
from tutorlake.sources.cutpages import cut_pages

# Keys that may hold the row list, in order of preference.
ATTENDANCE_KEYS = ("data", "rows", "report")
CATALOGUE_KEYS = ("response", "data", "courses", "bundles", "result", "items")
BATCH_KEY = "courses"

#: Bytes that a parsed document can hold.
DOCUMENT_LIMIT = 128 * 1024 * 1024
#: Reasons of rejected pages.
NOT_JSON, TOO_LARGE = "Not JSON", "too large"
_SIZE = "_metadata.file_size"


def read_pages(spark: SparkSession, paths: str | Sequence[str], one_per_line: bool = False, limit: int = DOCUMENT_LIMIT) -> DataFrame:
    """``page`` (file path), ``doc`` (VARIANT) and ``size`` (bytes) of landed replies.

    Several days or pages are several paths of one read.  Where there are files above ``limit`` they are cut by their
    structure: their rows come as several documents of the same shape, and ``first`` is the place of a document's first
    row.  ``doc`` is NULL when a page is no JSON, or when a page on a line of its own is too large for one value;
    :func:`page_rejects` lists such pages with their reason.
    """
    accept_repeated_keys(spark)
    paths = [paths] if isinstance(paths, str) else list(paths)
    text = spark.read.text(paths, wholetext=not one_per_line)
    large = not one_per_line and not text.where(F.col(_SIZE) > limit).select(F.lit(1)).isEmpty()
    if large:
        text = text.where(F.col(_SIZE) <= limit)
    pages = text.select(F.col("_metadata.file_path").alias("page"), "value", F.octet_length("value").alias("size"))
    small = staged(pages, doc=F.try_parse_json("value")).drop("value")
    if not large:
        return small
    cut = stored(cut_pages(spark, paths, limit, [*ATTENDANCE_KEYS, *CATALOGUE_KEYS, BATCH_KEY]), "cut-pages")
    parsed = staged(cut, doc=F.try_parse_json("value")).drop("value")
    # One broken entry makes its page broken, as it would be if it were read whole.
    broken = parsed.filter(F.col("doc").isNull()).select("page", "size").distinct()
    none = F.parse_json(F.lit(None).cast("string"))
    rejected = broken.select("page", "size", none.alias("doc"), F.lit(-1).cast("long").alias("first"))
    whole = parsed.join(broken.select("page"), "page", "left_anti").select("page", "size", "doc", "first")
    return small.withColumn("first", F.lit(0).cast("long")).unionByName(whole).unionByName(rejected)


def page_rejects(pages: DataFrame, limit: int = DOCUMENT_LIMIT) -> DataFrame:
    """``page``, ``size`` and ``reason`` of the pages that give no rows because they could not be read.

    A file of any size is read unless it is broken; only a page on a line of its own can be too large.
    """
    whole = F.col("first") >= 0 if "first" in pages.columns else F.lit(True)
    reason = F.when((F.col("size") > limit) & whole, F.lit(TOO_LARGE)).otherwise(F.lit(NOT_JSON))
    return pages.filter(F.col("doc").isNull()).select("page", "size", reason.alias("reason"))


def _list_at(doc: Column, *keys: str) -> Column:
    node = node_at(doc, *keys) if keys else doc
    return F.try_variant_get(node, "$", "array<variant>")


def _explode(pages: DataFrame, rows: Column, name: str, *carry: str) -> DataFrame:
    if "first" not in pages.columns:
        return pages.select(*carry, F.posexplode(rows).alias("pos", name))
    found = pages.select("*", F.posexplode(rows).alias("__at", name))
    return found.select(*carry, (F.col("__at") + F.col("first")).cast("int").alias("pos"), name)


def unwrap_rows(pages: DataFrame, *carry: str, keys: Sequence[str] = ATTENDANCE_KEYS) -> DataFrame:
    """One ``row`` per entry of the first key that is present and not null."""
    none = chosen = F.lit(None).cast("array<variant>")
    for key in reversed(keys):
        # A list counts whatever else there is; only where there is none does it matter whether the key holds another value.
        usable = text_at(F.col("doc"), key).isNotNull()
        chosen = F.coalesce(F.try_variant_get(F.col("doc"), path(key), "array<variant>"), F.when(usable, none).otherwise(chosen))
    return _explode(pages, chosen, "row", *carry)


def unwrap_catalogue(pages: DataFrame, *carry: str) -> DataFrame:
    """One ``item`` per course: a plain list, the first known key holding a list, or all values."""
    doc = F.col("doc")
    known = [_list_at(doc, key) for key in CATALOGUE_KEYS]
    values = F.map_values(F.try_variant_get(doc, "$", "map<string,variant>"))
    return _explode(pages, F.coalesce(_list_at(doc), *known, values), "item", *carry)


def _batches_of(bundle: Column) -> Column:
    """Batches of one bundle: a list, or a list written as JSON text; none when it is neither."""
    written = F.try_parse_json(F.when(is_string(node_at(bundle, "batch")), text_at(bundle, "batch")))
    listed = F.coalesce(_list_at(bundle, "batch"), _list_at(written), F.array().cast("array<variant>"))
    return F.transform(listed, lambda batch: F.struct(
        text_at(bundle, "bundle_id").alias("bundle_id"),
        text_at(bundle, "bundle_name").alias("bundle_name"),
        batch.alias("batch")))


def flatten_batches(pages: DataFrame, *carry: str) -> DataFrame:
    """One row per batch with its bundle's id and name; ``pos`` is its place on the page."""
    doc = F.col("doc")
    bundles = F.coalesce(_list_at(doc), _list_at(doc, BATCH_KEY))
    flat = F.flatten(F.transform(bundles, _batches_of))
    if "first" in pages.columns:
        # A document holds one bundle here; its batches come after those of the bundles before.
        flats = stored(pages.filter(F.col("doc").isNotNull()).select("*", flat.alias("__flat")).drop("doc"), "page-batches")
        counts = flats.select("page", "first", F.coalesce(F.size("__flat"), F.lit(0)).alias("__n"))
        before = total_before(counts, ["page", "first"], "__n", "__before", "page-batch-counts").drop("__n")
        begin = before.groupBy("page").agg(F.min("__before").alias("__begin"))
        offsets = before.join(begin, "page").select("page", "first", (F.col("__before") - F.col("__begin")).alias("first_batch"))
        placed = flats.join(offsets, ["page", "first"]).drop("first").withColumnRenamed("first_batch", "first")
        return _explode(placed, F.col("__flat"), "entry", *carry).select(*carry, "pos", "entry.*")
    rows = pages.select(*carry, F.posexplode(flat).alias("pos", "entry"))
    return rows.select(*carry, "pos", "entry.*")


def has_more_page(pages: DataFrame) -> DataFrame:
    flag = F.coalesce(F.try_variant_get("doc", "$.page_context.has_more_page", "boolean"), F.lit(False))
    return pages.withColumn("has_more", flag)


def number_rows(rows: DataFrame, page: str = "page", target: DataFrame | None = None) -> DataFrame:
    """``source_row`` by page order, then place on the page.

    Numbers continue after the target's highest.  Only one count per page is
    put in order, never the rows.
    """
    counts = rows.groupBy(F.col(page).alias("__page")).agg((F.max("pos") + 1).alias("__n"))
    if target is not None:
        # The target's rows act as one page before all others.
        stored = target.agg(F.coalesce(F.max("source_row") + 1, F.lit(0)).alias("__n"))
        counts = counts.unionByName(stored.withColumn("__page", F.lit(None).cast(rows.schema[page].dataType)))
    offsets = total_before(counts, [F.col("__page").asc_nulls_first()], "__n", "__offset", "page-offsets").drop("__n")
    number = (F.col("pos") + F.col("__offset")).alias("source_row")
    return rows.join(offsets, F.col(page) == F.col("__page")).select(*rows.columns, number)
