"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneltide.functions.materialize import new_folder
from paneltide.llm import chat, decontamination, line_dedup, manifest, packing, periodic, quality, secrets, sharding, simhash, sketches, toxicity, warc
from paneltide.llm.common import join_hot, split_words, table, text_of, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


def vocabulary() -> packing.Vocabulary:
    import public_tokenizers

    return packing.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op3_sharding", """
WITH steps AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i))),
octets AS (SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b FROM documents),
sized AS (
  SELECT doc_id, CAST(len(b) + 8 AS BIGINT) AS size,
    xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM octets, steps),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS begins, sum(size) OVER () AS whole FROM sized),
cut AS (SELECT *, CAST(begins * 24 // whole AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard FROM cut
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"))
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query("op4_secret_scans", """
WITH rules(kind, place, pattern, grp, least) AS (VALUES
  ('assign', 0, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  ('access', 1, 'AKIA[A-Z0-9]+', 0, 20), ('hex', 2, '[0-9a-f]+', 0, 24)),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS (
  SELECT r, kind, place, least, 
    CASE place WHEN 0 THEN regexp_extract_all(t, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)
      WHEN 1 THEN regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0) ELSE regexp_extract_all(t, '[0-9a-f]+', 0) END AS m,
    CASE place WHEN 0 THEN regexp_extract_all(t, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)
      WHEN 1 THEN regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0) ELSE regexp_extract_all(t, '[0-9a-f]+', 0) END AS v,
    CASE place WHEN 0 THEN regexp_split_to_array(t, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)')
      WHEN 1 THEN regexp_split_to_array(t, 'AKIA[A-Z0-9]+') ELSE regexp_split_to_array(t, '[0-9a-f]+') END AS g
  FROM docs, rules),
each AS (SELECT r, kind, place, least, unnest(m) AS m, unnest(v) AS v, unnest(list_slice(g, 1, len(m))) AS g, unnest(range(len(m))) AS pos FROM found),
ends AS (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY r, place ORDER BY pos ROWS UNBOUNDED PRECEDING) AS e FROM each),
spans AS (SELECT r, kind, place, e - length(m) AS s, e FROM ends WHERE length(v) >= least),
listed AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, place) AS spans FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (r)
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ledger = new_folder(spark, "secrets-ledger")
    secrets.scan(docs, path=ledger)
    found, _ = secrets.scan(docs, path=ledger)  # every pair is in the ledger by now, so no text is scanned again

    def many(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    text = F.concat_ws(",", F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    rows = found.withColumnRenamed("spans", "found").withColumn("spans", text)
    return rows.select("doc_id", many("assign"), many("access"), many("hex"), F.sha2(F.col("spans"), 256).alias("base_sha256"), "spans")


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, half, n, next_id, next_n): the next smaller id, and the largest after the smallest; a null id is the smallest."""
    rows = written(ids.repartitionByRange(F.col("doc_id").desc_nulls_last()).withColumn("part", F.spark_partition_id()), "ids")
    order = F.col("doc_id").desc_nulls_last()
    top = F.min(F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("less"), F.col("doc_id").alias("id"), F.col("n").alias("n"))).alias("top")
    firsts = rows.groupBy("part").agg(top)  # one row a partition
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("top").over(Window.orderBy("part")), F.first("top").over(every))
    firsts = written(firsts.select("part", after.alias("after")), "firsts")
    follows = F.lead(F.struct(F.col("doc_id").alias("id"), F.col("n").alias("n"))).over(Window.partitionBy("part").orderBy(order))
    found = rows.join(firsts, "part").withColumn("next", F.coalesce(follows, F.struct("after.id", "after.n")))
    return found.select("doc_id", "half", "n", F.col("next.id").alias("next_id"), F.col("next.n").alias("next_n"))


@query("op7_document_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text_of("text").alias("text"))
    ids = docs.groupBy("doc_id").agg(F.max(F.floor(F.length("text") / 2)).cast("int").alias("half"), F.count("*").alias("n"))
    nexts = written(next_ids(ids), "next")
    total = nexts.agg(F.sum("n")).first()[0] or 0
    # The next document gives the start of its text and its sketch; rows of one id give the least of theirs.
    takers = nexts.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("taker"), "half", F.col("n").alias("taken"), "next_n")
    givers = join_hot(docs, takers, "doc_id", "next_n", total).select("taker", "taken", "half", "text", split_words(F.col("text")).alias("words"))
    given = givers.select("taker", "taken", F.struct(F.left("text", "half").alias("filler"), sketches.sketch("words").alias("next_sketch")).alias("given"))
    given = given.groupBy(F.col("taker").alias("doc_id"), "taken").agg(F.min("given").alias("given"))
    rows = join_hot(docs, given, "doc_id", "taken", total).select(
        "doc_id", "text", F.length("text").cast("long").alias("n_chars"), "given.filler", "given.next_sketch")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", (F.col("n_chars") - half).cast("int")), F.left("filler", half))
    rows = rows.select("doc_id", "text", "n_chars", "next_sketch", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "next_sketch", F.sha2(F.col("edited"), 256).alias("edited_sha256"), split_words(F.col("text")).alias("words"), split_words(F.col("edited")).alias("edited_words"))
    own = rows.select("doc_id", "n_chars", "edited_sha256", "next_sketch", sketches.sketch("words").alias("own"), sketches.sketch("edited_words").alias("edited"))
    return own.select(
        "doc_id", "n_chars", "edited_sha256", sketches.as_text(F.col("own")).alias("fingerprint"), sketches.as_text(F.col("edited")).alias("edited_fingerprint"),
        sketches.resemblance(F.col("own"), F.col("edited")).alias("near_edited"), sketches.resemblance(F.col("own"), F.col("next_sketch")).alias("near_next"))


@query("op8_warc", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS digest FROM pages),
d AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(digest, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31), 1)), '') AS payload_digest FROM p)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM d
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op11_chat_formatting", r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, regexp_replace(regexp_replace(text, '<(\\*)(s>|/s>|<SYS>>|</SYS>>)', '<\\\1\2', 'g'),
    '\[(\\*)(INST\]|/INST\]|ROLE\]|SAYS\]|/ROLE\])', '[\\\1\2', 'g') AS safe,
  regexp_replace(regexp_replace(role, '<(\\*)(s>|/s>|<SYS>>|</SYS>>)', '<\\\1\2', 'g'),
    '\[(\\*)(INST\]|/INST\]|ROLE\]|SAYS\]|/ROLE\])', '[\\\1\2', 'g') AS safe_role FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(safe) + CASE role WHEN 'system' THEN 19 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 ELSE length(safe_role) + 23 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_digests(chat.format_chats(given.unionByName(added)))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(table(spark, sf_dir, "documents"), with_planted=True))


def _manifest_sql(levels: int, upper: int) -> str:
    """Trees level by level: `levels` for a source, `upper` over the sources, enough for three to that power."""
    ctes = [
        "steps AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), "
        "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i)))",
        "odd AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ord(x))), "
        "lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 2 AS keeps FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), steps)",
        "f AS (SELECT d.doc_id, source, text, CASE WHEN keeps = 0 THEN replace(text, chr(10), '') ELSE text END AS later, concat("
        + ", ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("d.doc_id", "source", "lang", "n_chars"))
        + ") AS head FROM documents d LEFT JOIN odd ON odd.doc_id = d.doc_id)",
        "h AS (SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(later) || ':' || later, '-')) AS now FROM f)",
        "l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, "
        "coalesce('=' || source, '') AS tree FROM h)",
        "a0 AS (SELECT tree, i, leaf AS d, count(*) OVER (PARTITION BY tree) AS n FROM l)",
    ]

    def level(a: str, k: int) -> None:
        ctes.append(
            f"{a}{k + 1} AS (SELECT tree, i // 3 AS i, CASE WHEN max(n) = 1 THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d, "
            f"CAST(ceil(max(n) / 3) AS BIGINT) AS n FROM {a}{k} GROUP BY tree, i // 3)")
        ctes.append(
            f"{a}s{k} AS (SELECT x.tree, x.i, string_agg(y.d, '' ORDER BY y.i) FILTER (y.i < x.i) AS lo, string_agg(y.d, '' ORDER BY y.i) FILTER (y.i > x.i) AS hi, max(x.n) AS n "
            f"FROM {a}{k} x JOIN {a}{k} y ON y.tree = x.tree AND y.i // 3 = x.i // 3 GROUP BY x.tree, x.i)")

    def walk(a: str, k: int, p: str, q: str, tree: str) -> None:
        ctes.append(
            f"{q} AS (SELECT p.* EXCLUDE (now, proof), proof || coalesce(s.lo, '') || coalesce(s.hi, '') AS proof, "
            f"CASE WHEN s.n = 1 THEN now ELSE sha256(coalesce(s.lo, '') || now || coalesce(s.hi, '')) END AS now "
            f"FROM {p} p JOIN {a}s{k} s ON s.tree = {tree} AND s.i = p.{'i' if a == 'a' else 'j'} // {3 ** k})")

    for k in range(levels):
        level("a", k)
    ctes.append(f"b0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, tree AS key, d, count(*) OVER () AS n FROM a{levels})")
    for k in range(upper):
        level("b", k)
    ctes.append("w0 AS (SELECT l.doc_id, l.leaf, l.tree, l.i, b0.i AS j, b0.d AS subroot, now, '' AS proof FROM l JOIN b0 ON b0.key = l.tree)")
    for k in range(levels):
        walk("a", k, f"w{k}", f"w{k + 1}", "p.tree")
    for k in range(upper):
        walk("b", k, f"w{levels + k}", f"w{levels + k + 1}", "''")
    return f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, r.d AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = r.d AS verified FROM w{levels + upper}, b{upper} r"


@query("op13_merkle_manifest", _manifest_sql(12, 6))
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}
    return manifest.manifest(table(spark, sf_dir, "documents"), altered=later, is_altered=F.crc32(F.col("doc_id").cast("string")) % 2 == 0)


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_line_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents"), anywhere=True).select(
        "doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_gone").alias("n_removed"), F.col("_removed").alias("removed"))
