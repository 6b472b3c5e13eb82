"""One query per operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.llm.ball_tree import top_k
from msgflow.llm.bpe import encode_digests
from msgflow.llm.chunk_recipes import exact_groups
from msgflow.llm.filter_audit import filter_audit
from msgflow.llm.id_files import id_file_report
from msgflow.llm.license_templates import license_report
from msgflow.llm.mixing import mix_report
from msgflow.llm.odd_sketch import near_groups
from msgflow.llm.registry import ORACLE, QUERIES, query
from msgflow.llm.secret_scan import secret_spans
from msgflow.llm.suffix_repeats import repeated_bytes
from msgflow.llm.token_counts import section_tokens
from msgflow.llm.toxicity import toxicity_report
from msgflow.llm.vector_codes import ENTRIES, PARTS, ROUNDS, vector_codes

__all__ = ["ORACLE", "QUERIES"]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's vocabulary file; another path can be given to the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_near_dedup", sql=r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE
           WHEN len(w) = 0 THEN []
           WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words
), sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS item FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT s.doc_id, s.n AS n_shingles, min(r.b) AS component_id, min(r.b) = s.doc_id AS kept
FROM sizes s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.n
""")
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir), width=4)


@query("op2_bpe")
def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir), vocabulary())


@query("op3_licenses")
def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir))


@query("op4_suffix_repeats")
def suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir))


@query("op5_exact_dedup", sql="""
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
""")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir))


@query("op6_top_k", sql="""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
""")
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op7_secrets")
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir))


@query("op8_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op9_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return section_tokens(table(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op10_mixing", sql=r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\f\r]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, 2.0 * source_size AS bound,
         (sum(source_size) OVER () * 1.5 - coalesce(sum(2.0 * source_size) OVER before, 0))
           / sum(weight) OVER after AS level
  FROM sources
  WINDOW before AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), targets AS (
  SELECT source, source_size,
         CAST(CASE WHEN bound <= level * weight THEN bound
              ELSE weight * (SELECT max(level) FROM filled WHERE bound > level * weight) END AS DOUBLE) AS target
  FROM filled
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS INTEGER) ELSE 0 END AS times,
         CASE WHEN source_size > 0 THEN target - floor(target / source_size) * source_size ELSE 0 END AS budget
  FROM targets
), running AS (
  SELECT d.*, b.source_size, b.target, b.times, b.budget,
         sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY d.source, h) AS own
  FROM sized d JOIN budgets b ON b.source IS NOT DISTINCT FROM d.source
), placed AS (
  SELECT *, CASE WHEN upto <= budget THEN 1
                 WHEN upto - own > budget THEN 0
                 WHEN budget - (upto - own) <= upto - budget THEN 0
                 ELSE 1 END AS extra
  FROM running
)
SELECT doc_id, size, source_size, target, CAST(size * (times + extra) AS BIGINT) AS taken FROM placed
""")
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir))


@query("op11_filter_audit", sql=r"""
WITH found AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS w
  FROM documents
), marked AS (
  SELECT doc_id, part, [
           len(w) < 200,
           100 * len(list_distinct(w)) < 50 * len(w),
           100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t),
           regexp_matches(t, '[#$%&*|]'),
           coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)] AS fails
  FROM found
), labelled AS (
  SELECT m.*, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad
  FROM marked m LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS f
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps AS (SELECT filter_order, f, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
sets AS (SELECT DISTINCT part, fails, good, bad, count(*) AS n FROM labelled GROUP BY ALL),
seen AS (
  SELECT part, filter_order, step, f[step] AS k, fails, good, bad, n, fails[f[step]] AS hit,
         len(list_filter(f[1:step - 1], lambda i: fails[i])) > 0 AS gone
  FROM sets, steps
), counted AS (
  SELECT part, filter_order, step, any_value(k) AS k,
         coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0) AS kept,
         coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (hit AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (hit AND len(list_filter(fails, lambda x: x)) = 1), 0) AS unique_fails,
         coalesce(sum(n) FILTER (hit AND NOT gone AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (hit AND NOT gone AND bad), 0) AS toxic_lost
  FROM seen GROUP BY part, filter_order, step
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley
FROM counted
""")
def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


def _codes_sql() -> str:
    """The rounds written out: parts as rows of components, one pair of tables for each round."""
    steps = [f"""kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({4096} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), comps AS MATERIALIZED (
  SELECT r, (i - 1) // (len(v) // {PARTS}) AS p, (i - 1) % (len(v) // {PARTS}) AS j, v[i] AS x
  FROM (SELECT r, v, unnest(range(1, len(v) + 1)) AS i FROM kept)
), book0 AS MATERIALIZED (SELECT p, r AS e, j, x AS c FROM comps WHERE r < {ENTRIES})"""]
    for k in range(ROUNDS + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT r, p, min(d * {ENTRIES} + e) AS de FROM (
    SELECT r, b.p, e, sum((x - c) * (x - c)) AS d FROM comps x JOIN book{k} b ON x.p = b.p AND x.j = b.j GROUP BY r, b.p, e
  ) GROUP BY r, p
)""")
        if k < ROUNDS:
            steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.j, CASE WHEN n IS NULL THEN c ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS c
  FROM book{k} b LEFT JOIN (
    SELECT x.p, x.j, de % {ENTRIES} AS e, sum(x) AS s, count(*) AS n
    FROM comps x JOIN near{k} a ON a.r = x.r AND a.p = x.p GROUP BY ALL
  ) m ON m.p = b.p AND m.e = b.e AND m.j = b.j
)""")
    return "WITH " + ", ".join(steps) + f""", coded AS (
  SELECT r, string_agg(printf('%02x', CAST(de % {ENTRIES} AS INTEGER)), '' ORDER BY p) AS code,
         CAST(sum(de // {ENTRIES}) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) FROM book{ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""


@query("op12_vector_codes", sql=_codes_sql())
def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


@query("op13_id_files")
def id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_file_report(table(spark, sf_dir), vocabulary("byte_bpe_50k.json"))
