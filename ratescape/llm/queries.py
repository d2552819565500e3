"""The operators as queries over the benchmark tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescape.llm import align, decontaminate, fair_mix, fertility, jaccard_join, line_dedup, lm, merkle, private_data, rp_forest, secret_scan, spans, suffix_dedup, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    text = F.coalesce("text", F.lit(""))
    return found.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(F.encode(text, "utf-8"), 256).alias("kept_sha256"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    histories = warc.capture_histories(_table(spark, sf_dir, "pages"))
    return histories.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _span_digest(found: DataFrame, kinds: tuple[str, ...], *more: str) -> DataFrame:
    base = F.col("_base")
    counts = [spans.count(base, k).alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(spans.joined(base), 256).alias("base_sha256"), spans.joined(F.col("_all")).alias("spans"), *more)


def op3_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(secret_scan.scan(_table(spark, sf_dir, "documents")), secret_scan.KINDS[:3], "n_live", "n_examples", "n_copied_owners", "n_copied_inside")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), n=3, percent=90)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.contamination(docs.select("doc_id", "text"), benchmark, window=10))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), size=100)


def op7_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(private_data.find_private(_table(spark, sf_dir, "documents")), private_data.KINDS)


def op8_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.interpolated_scores(_table(spark, sf_dir, "documents"))


def op9_quality_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality_measures(_table(spark, sf_dir, "documents"))


def op10_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fair_mix.sized(_table(spark, sf_dir, "documents"))
    mixed = fair_mix.mix_totals(rows, fair_mix.cycled_weights(rows))
    return mixed.select(*(F.col(f"_{c}").alias({"id": "doc_id"}.get(c, c)) for c in ("id", "source", "size", "source_size", "target", "taken")))


def op11_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.nearest(_table(spark, sf_dir, "embeddings"), every=20, k=20)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    lowered = {c: F.translate(c, _UPPER, _LOWER) if c == "text" else F.col(c) for c in merkle.FIELDS}
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.digest(lowered))
    rows = merkle.manifest(merkle.leaves(docs, carry={"tampered": tampered}))
    rows = rows.withColumn("shown", F.coalesce("tampered", "_digest")).withColumn("folded_root", merkle.folded("shown"))
    digests = [F.col("_digest").alias("leaf"), "subroot", "root", F.sha2(merkle.siblings(), 256).alias("proof_sha256"), "folded_root"]
    return rows.select(F.col("_order").alias("doc_id"), *digests, (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.align(_table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    docs = found.documents.select("block", "at", F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"))
    sums = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return docs.join(found.scores, ["block", "at"], "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *sums, "groups_sha256")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_warc, op3_secret_ownership, op4_jaccard_join, op5_decontaminate, op6_suffix_dedup, op7_private_data, op8_interpolated_lm, op9_quality_fertility, op10_fair_mix, op11_rp_forest, op12_merkle_manifest, op13_cross_alignment)}



def _leaf_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"


# the CRC register takes a byte of the id, then eight shifts by one bit
_CRC32_SQL = """xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda r, b: xor(xor(r, b) >> 1, 3988292384::BIGINT * (xor(r, b) & 1))), 4294967295::BIGINT)"""

SQL = {
    "op1_line_dedup": rf"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, i, lines[i] AS line,
    translate(regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS key
  FROM split, unnest(range(1, len(lines) + 1)) AS t(i)
), repeated AS (
  SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(r.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (r.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN repeated r USING (key) GROUP BY doc_id""",
    "op2_warc": """
WITH records AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM records WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM records LEFT JOIN firsts USING (payload_digest)""",
    "op4_jaccard_join": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, w[i:i + 2] AS s FROM words, unnest(range(1, greatest(len(w) - 1, 2))) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes sa ON sa.doc_id = a.doc_id JOIN sizes sb ON sb.doc_id = b.doc_id
  WHERE 100 * sa.n >= 90 * sb.n AND 100 * sb.n >= 90 * sa.n
  GROUP BY a.doc_id, b.doc_id, sa.n, sb.n
  HAVING 100 * count(*) >= 90 * (sa.n + sb.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(y) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.x = doc_id
GROUP BY doc_id, n""",
    "op5_decontaminate": rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, w[i:i + 9] AS s FROM items, unnest(range(1, greatest(len(w) - 8, 2))) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT len(s) AS n FROM windows
), places AS (
  SELECT doc_id, i, n, w[i:i + n - 1] AS s FROM words, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
), hits AS (
  SELECT doc_id, i, n, item_id FROM places JOIN windows USING (s)
), hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(j) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op6_suffix_dedup": """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT doc_id, i, md5_number(substring(h, 2 * i + 1, 200)) AS w FROM bytes, unnest(range(0, length(h) // 2 - 99)) AS t(i)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1
), marked AS (
  SELECT doc_id, i, i > lag(i, 1, i - 101) OVER (PARTITION BY doc_id ORDER BY i) + 100 AS opens FROM later
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked) GROUP BY doc_id, span
), gaps AS (
  SELECT doc_id, b, substring(h, 2 * lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) + 1, 2 * (a - lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a))) AS gap, b - a AS n
  FROM spans JOIN bytes USING (doc_id)
), cut AS (
  SELECT doc_id, string_agg(gap, '' ORDER BY b) AS kept, max(b) AS b, sum(n)::BIGINT AS n_removed, count(*) AS n_spans FROM gaps GROUP BY doc_id
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN kept IS NULL THEN h ELSE kept || substring(h, 2 * b + 1) END)) AS kept_sha256
FROM bytes LEFT JOIN cut USING (doc_id)""",
    "op12_merkle_manifest": rf"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, {_leaf_sql('text')} AS leaf, {_CRC32_SQL} % 3 = 0 AS is_tampered,
    {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS lowered,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos
  FROM documents
), nodes AS (
  SELECT tree, 0 AS level, pos, count(*) OVER (PARTITION BY tree) AS n, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 8, n
), tops AS (
  SELECT 0 AS level, tree AS pos, count(*) OVER () AS n, digest FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 8, n
), heights AS (
  SELECT tree, max(level) AS height FROM nodes GROUP BY tree
), runs AS (
  SELECT tree, level, pos // 8 AS run, list(digest ORDER BY pos) AS digests FROM nodes WHERE n > 1 GROUP BY ALL
), top_runs AS (
  SELECT level, pos // 8 AS run, list(digest ORDER BY pos) AS digests FROM tops WHERE n > 1 GROUP BY ALL
), steps AS (
  SELECT doc_id, r.level AS step, digests, (pos >> (3 * r.level)) % 8 AS place
  FROM leaves l JOIN runs r ON r.tree = l.tree AND r.run = l.pos >> (3 * r.level + 3)
  UNION ALL
  SELECT doc_id, height + r.level, digests, (l.tree >> (3 * r.level)) % 8
  FROM leaves l JOIN heights h USING (tree) JOIN top_runs r ON r.run = l.tree >> (3 * r.level + 3)
), parts AS (
  SELECT doc_id, step, array_to_string(digests[1:place], '') AS before, array_to_string(digests[place + 2:], '') AS after FROM steps
), proofs AS (
  SELECT doc_id, string_agg(before || after, '' ORDER BY step) AS proof FROM parts GROUP BY doc_id
), folds AS (
  SELECT doc_id, 0 AS step, CASE WHEN is_tampered THEN lowered ELSE leaf END AS digest FROM leaves
  UNION ALL
  SELECT doc_id, f.step + 1, sha256(before || digest || after) FROM folds f JOIN parts p USING (doc_id, step)
), folded AS (
  SELECT doc_id, arg_max(digest, step) AS folded_root FROM folds GROUP BY doc_id
)
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = t.digest AS verified
FROM leaves l JOIN nodes s ON s.tree = l.tree AND s.n = 1 JOIN tops t ON t.n = 1
  JOIN folded USING (doc_id) LEFT JOIN proofs USING (doc_id)""",
}
