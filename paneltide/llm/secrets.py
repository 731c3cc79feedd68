r"""Secret scans over an incremental ledger of blobs.

Every text is a version stored under its content address, the SHA-256 of its UTF-8 bytes. The
ledger holds one row (blob, rule, version, spans) for each pair of a blob and a rule version
that was ever scanned, also where nothing was found. A run looks up which pairs of its
blobs are missing, reads one text for each such blob, scans it with the missing rules alone,
adds their rows to the ledger and joins the ledger back to all documents that hold the blob.

Positions come from the texts between the matches: the start of match i is the length of all
texts and matches before it. They count code points; ends are exclusive. A match that fails its
rule's least length is dropped after it was found, so it still uses up its characters.

Results for odd input: a null text is an empty one; repeated rows get a row each; a null id stays
null; without rows the result and the ledger are empty; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneltide.llm.common import join_hot, text_of, written


@dataclass(frozen=True)
class Rule:
    """kind, version of its definition, pattern, the group whose length counts, its least length,
    and a cheap screen: a text for which it is false has no match."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    screen: object


def _named(text: Column) -> Column:
    low = F.lower(text)
    return low.contains("pass") | low.contains("secret") | low.contains("token") | low.contains("api")


# The kinds in their order, their patterns and least lengths.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, _named),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, lambda text: text.contains("AKIA")),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24, lambda text: text.rlike("[0-9a-f]{24}")),
)
LEDGER = "blob binary, rule string, version int, spans array<struct<start:long,end:long>>"


def _matches(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rule, start, end) of the matches that pass."""
    none = F.array().cast("array<string>")

    def found(rule: Rule) -> Column:
        go = F.array_contains("todo", rule.kind) & rule.screen(F.col("text"))
        pattern = F.lit(rule.pattern)
        return F.struct(
            F.lit(rule.kind).alias("rule"), F.lit(rule.least).alias("least"),
            F.when(go, F.regexp_extract_all("text", pattern, F.lit(0))).otherwise(none).alias("match"),
            F.when(go, F.regexp_extract_all("text", pattern, F.lit(rule.group))).otherwise(none).alias("value"),
            F.when(go, F.split("text", rule.pattern, -1)).otherwise(none).alias("gap"))

    each = texts.select("blob", F.explode(F.array(*[found(r) for r in rules])).alias("f")).filter(F.size("f.match") > 0)
    zipped = F.arrays_zip(F.col("f.match").alias("match"), F.col("f.value").alias("value"), F.slice("f.gap", F.lit(1), F.size("f.match")).alias("gap"))
    rows = each.select("blob", "f.rule", "f.least", F.posexplode(zipped).alias("pos", "m"))
    rows = rows.select("blob", "rule", "least", "pos", F.length("m.match").alias("wide"), F.length("m.value").alias("value"), F.length("m.gap").alias("gap"))
    upto = Window.partitionBy("blob", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("wide")).over(upto)
    return rows.withColumn("end", end).filter("value >= least").select("blob", "rule", (F.col("end") - F.col("wide")).alias("start"), "end").distinct()


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, ledger): (doc_id, spans) of every row, and the ledger with all pairs of this run.

    The ledger comes from the table at `path`, where one is named; it is made there by the first run,
    gets the rows of this one, and outlives the session. spans is an array of (start, kind's place among the rules, kind, end) in order.
    """
    spark = docs.sparkSession
    if path and ledger is None and _exists(spark, path):
        ledger = spark.read.schema(LEDGER).parquet(path)
    ledger = spark.createDataFrame([], LEDGER) if ledger is None else ledger
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    current = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    blob = F.unhex(F.sha2(text_of(text_col).cast("binary"), 256))
    versions = written(docs.select(F.col(id_col).alias("doc_id"), blob.alias("blob")), "versions")
    blobs = written(versions.groupBy("blob").agg(F.min("doc_id").alias("holder"), F.count("*").alias("n")), "blobs")
    total = versions.count()

    pairs = blobs.select("blob", "holder", F.explode(current).alias("r")).select("blob", "holder", "r.rule", "r.version")
    unseen = pairs.join(ledger, ["blob", "rule", "version"], "left_anti")
    todo = written(unseen.groupBy("blob").agg(F.first("holder").alias("holder"), F.collect_set("rule").alias("todo")), "todo")
    held = docs.select(F.col(id_col).alias("doc_id"), blob.alias("_blob"), text_of(text_col).alias("text"))
    texts = held.join(todo, F.col("doc_id").eqNullSafe(F.col("holder")) & (F.col("_blob") == F.col("blob"))).select("blob", "todo", "text")
    spans = _matches(texts, rules).groupBy("blob", "rule").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))

    versioned = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    if todo.isEmpty():  # nothing new: no text is read
        spans = spark.createDataFrame([], spans.schema)
    scanned = todo.select("blob", F.explode("todo").alias("rule")).withColumn("version", versioned[F.col("rule")])
    added = scanned.join(spans, ["blob", "rule"], "left").select(
        "blob", "rule", "version", F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("spans"))
    added = written(added, "added")
    now = written(ledger.select("blob", "rule", "version", "spans").unionByName(added), "ledger")
    if path:
        added.write.mode("append").parquet(path)

    live = now.filter(F.col("version") == versioned[F.col("rule")]).select("blob", "rule", F.explode("spans").alias("s"))
    one = F.struct(F.col("s.start").alias("start"), order[F.col("rule")].alias("place"), F.col("rule").alias("kind"), F.col("s.end").alias("end"))
    per_blob = live.groupBy("blob").agg(F.sort_array(F.collect_list(one)).alias("spans")).join(blobs.select("blob", "n"), "blob")
    result = join_hot(versions, per_blob, "blob", "n", total, how="left")
    empty = F.array().cast("array<struct<start:long,place:int,kind:string,end:long>>")
    return result.select("doc_id", F.coalesce("spans", empty).alias("spans")), now
