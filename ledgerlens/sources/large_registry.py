"""Registry documents of any length: one JSON object per file, read in parts.

:func:`ledgerlens.sources.ledger.parse_registry` parses a document in the task
that reads its line. Here a file is read in splits, as pieces between commas. A
comma separates two entries where it stands outside strings and two objects
deep, which prefix sums tell: of the parity of quotes, then of the nesting
depth. They are summed within each split for either state that the split may
begin in, then over the splits (one row for each), so no task ever sees more
than a split, or one entry.

Entries are what ``parse_registry`` returns for the same text: the last of a
name counts, entries without id or category stop the job, and so does text
that is no JSON object: each entry is parsed FAILFAST, and what stands between
them must be sound brackets. An empty file, or one of blanks, holds no document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions.columns import must
from ledgerlens.schemas import SCAM_DOCUMENT
from ledgerlens.sources.ledger import checked_entries

SPLIT = ("file", "block")


def _pieces(spark: SparkSession, path) -> DataFrame:
    """The text between commas, with its place: file, split, and order in it."""
    return spark.read.text(path, lineSep=",").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("piece"),
    )


def _deeper(outside: Column) -> Column:
    """How much deeper the text is at its end than at its start."""
    return F.length(F.regexp_replace(outside, r"[^{\[]", "")) - F.length(F.regexp_replace(outside, r"[^}\]]", ""))


def _marked(pieces: DataFrame) -> DataFrame:
    """``inside``: the piece begins in a string; ``depth``: the objects and
    arrays open where it begins; ``net``: how many more where it ends."""
    # No escape sequence goes beyond a comma: what is left of one is no JSON.
    parts = F.split(F.regexp_replace("piece", r"(?s)\\.", ""), '"', -1)
    df = pieces.withColumn("parts", parts).withColumn("quotes", F.size("parts") - 1)
    for k in (0, 1):  # the piece begins outside, or inside a string
        outside = F.array_join(F.expr(f"filter(parts, (part, i) -> i % 2 = {k})"), "")
        df = df.withColumn(f"net{k}", _deeper(outside))
    before = Window.partitionBy(*SPLIT).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    df = df.drop("parts").withColumn("parity", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    for k in (0, 1):  # the split begins outside, or inside a string
        df = df.withColumn(f"n{k}", F.when((F.col("parity") + k) % 2 == 0, F.col("net0")).otherwise(F.col("net1")))
        df = df.withColumn(f"d{k}", F.coalesce(F.sum(f"n{k}").over(before), F.lit(0)))
    totals = df.groupBy(*SPLIT).agg(F.sum("quotes").alias("q"), F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = totals.withColumn("state", F.coalesce(F.sum("q").over(earlier), F.lit(0)) % 2)
    splits = splits.withColumn("t", F.when(F.col("state") == 0, F.col("t0")).otherwise(F.col("t1")))
    splits = splits.withColumn("base", F.coalesce(F.sum("t").over(earlier), F.lit(0)))
    joined = df.join(splits.select(*SPLIT, "state", "base"), list(SPLIT))
    chosen = F.col("state") == 0
    return joined.select(
        *SPLIT, "place", "piece", "quotes",
        ((F.col("parity") + F.col("state")) % 2 == 1).alias("inside"),
        (F.col("base") + F.when(chosen, F.col("d0")).otherwise(F.col("d1"))).alias("depth"),
        F.when(chosen, F.col("n0")).otherwise(F.col("n1")).alias("net"),
    )


def _units(marked: DataFrame) -> DataFrame:
    """(file, top, unit, depth, net, text): what begins at a comma at most two
    objects deep, up to the next such comma; ``top`` numbers those that begin
    in the document itself."""
    df = marked.withColumn("first", (~F.col("inside") & (F.col("depth") <= 2)).cast("int"))
    df = df.withColumn("outer", F.when(F.col("depth") <= 1, F.col("first")).otherwise(0))
    upto = Window.partitionBy(*SPLIT).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = df.groupBy(*SPLIT).agg(F.sum("first").alias("f"), F.sum("outer").alias("o"))
    splits = splits.select(*SPLIT, *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("f", "o")))
    df = df.withColumn("unit", F.sum("first").over(upto)).withColumn("top", F.sum("outer").over(upto)).join(splits, list(SPLIT))
    whole = df.groupBy("file", (F.col("top") + F.col("o")).alias("top"), (F.col("unit") + F.col("f")).alias("unit")).agg(
        F.min(F.struct("block", "place", "depth")).alias("begin"),
        F.sum("net").alias("net"),
        F.sort_array(F.collect_list(F.struct("block", "place", "piece"))).alias("pieces"),
    )
    text = F.array_join(F.transform("pieces", lambda p: p["piece"]), ",")
    return whole.select("file", "top", "unit", F.col("begin.depth").alias("depth"), "net", text.alias("text"))


def read_large_registry(spark: SparkSession, path) -> DataFrame:
    """Registry entries of files that hold one document each, whatever their
    length: name, id, category, status, addresses."""
    marked = _marked(_pieces(spark, path))
    ends = marked.groupBy("file").agg((F.sum("quotes") % 2).alias("open"), F.sum("net").alias("net"), F.min("depth").alias("least"))
    units = _units(marked).join(ends.select("file", "open", F.col("net").alias("end"), "least"), "file")
    units = units.where(F.trim(F.regexp_replace("text", r"\s", "")) != "")
    sound = (F.col("open") == 0) & (F.col("end") == 0) & (F.col("least") >= 0)
    units = units.where(must(sound, F.concat(F.lit("malformed registry document: "), F.col("file"))))
    # A unit of the document itself ends in the value of its last key.
    opened = F.regexp_extract("text", r'(?s)^\s*\{?\s*"result"\s*:\s*\{(.*)$', 1)
    named = F.col("text").rlike(r'(?s)^\s*\{?\s*"result"\s*:\s*\{')
    # A value that raises, not a filter: no rule of the optimizer can go around it.
    missing = F.raise_error(F.concat(F.lit("registry document without result: "), F.col("file"))).cast("bigint")
    last = units.where("depth <= 1").groupBy("file").agg(F.max(F.when(named, F.col("top"))).alias("kept"))
    last = last.select("file", F.coalesce("kept", missing).alias("kept"))
    entries = units.join(last, "file").where(F.col("top") == F.col("kept"))
    # What the unit closes beyond itself belongs to the document.
    inner = F.when(F.col("depth") <= 1, opened).otherwise(F.col("text"))
    beyond = (F.lit(2) - F.col("depth") - F.col("net")).cast("int")
    closers = F.concat(F.lit(r"(?s)(\s*\}){"), beyond.cast("string"), F.lit(r"}\s*$"))
    entry = F.when(beyond > 0, F.regexp_replace(inner, closers, F.lit(""))).otherwise(inner)
    doc = F.from_json(F.concat(F.lit('{"result":{'), entry, F.lit("}}")), SCAM_DOCUMENT, {"mode": "FAILFAST"})
    pairs = entries.select("file", "unit", F.explode(F.map_entries(doc.getField("result"))).alias("pair"))
    named_last = pairs.groupBy("file", F.col("pair.key").alias("name")).agg(F.max_by("pair.value", "unit").alias("entry"))
    return checked_entries(named_last)
