"""The registered queries of this subpackage and their SQL for comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, exact_dedup, minhash, mixing, scoring, secrets, sharding, substrings, toxicity, warc

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op10_exact_dedup",
    """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
""",
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the table with the row of its group that stays; the stream reads the files themselves."""
    out = exact_dedup.exact_dedup(spark, f"{sf_dir}/documents.parquet")
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query(
    "op7_source_mixing",
    r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           CAST('0x' || substr(md5('20240229/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5::DOUBLE WHEN 1 THEN 2::DOUBLE ELSE 1::DOUBLE END AS weight, (source_size * 3)::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE AS budget FROM s),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT *, CASE WHEN cap <= level * weight THEN cap ELSE coalesce((SELECT arg_min(x.level, (x.cap / x.weight, x.rank)) FROM l AS x WHERE x.cap > x.level * x.weight) * weight, cap) END AS target,
      greatest(1, floor(budget / 65536))::BIGINT AS bt FROM l),
q AS (SELECT rank, target / (2 * k + 1) AS quotient, k FROM (SELECT rank, target, unnest(range(0, (target / bt)::BIGINT * 2 + 100)) AS k FROM t WHERE target > 0)),
won AS (SELECT rank, count(*) AS quota FROM (SELECT rank, row_number() OVER (ORDER BY quotient DESC, rank, k) AS place FROM q) WHERE place <= (SELECT max(floor(budget / bt)) FROM t) GROUP BY rank),
p AS (SELECT t.*, least(coalesce(quota, 0) * bt, source_size * 3) AS tokens FROM t LEFT JOIN won USING (rank)),
x AS (SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, size, rid ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start FROM d)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE CAST(tokens // source_size * size + greatest(0, least(size, tokens % source_size - start)) AS BIGINT) END AS taken
FROM x JOIN p ON x.source IS NOT DISTINCT FROM p.source
""",
)
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, as the sum over the shards that hold its blocks."""
    return mixing.mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_vector_sharding")
def op3_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document by vector bin packing. SQL has no such packing: tests compare it with a plain version."""
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


@query(
    "op1_warc_transactions",
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT html, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY html)
SELECT page_id, n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN top <> page_id THEN top END AS refers_to
FROM p LEFT JOIN g ON p.html = g.html AND n >= 1000
""",
)
def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives, read back and assembled; refers_to is the page of the record that a revisit names."""
    captures = warc.round_trip(table(spark, sf_dir, "pages"))
    return captures.select("metadata.page_id", "response.payload_bytes", "response.payload_digest", F.col("response.type").alias("record_type"), F.col("original_page").alias("refers_to"))


@query(
    "op5_decontamination",
    r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT rid, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
m AS (SELECT rid, dw.k, i, item_id FROM dw JOIN win ON dw.g = win.g AND dw.k = win.k),
h AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM m) GROUP BY rid),
its AS (SELECT rid, count(*) AS n, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN its USING (rid)
""",
)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document."""
    found = decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hits = decontamination.n_hit()
    return found.select(F.col("key").alias("doc_id"), "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"), decontamination.digest().alias("items_sha256"), (hits > 0).alias("contaminated"))


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All spans of whole texts; compression is beyond SQL, the base kinds have theirs in ``base_secret_spans``."""
    return secrets.scan(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def _each(pattern: str, kind: int, least: int, group: str = "") -> str:
    """SQL: (doc_id, kind, start, stop) of a pattern's matches, whose places are summed from what stands between them."""
    return f"""SELECT doc_id, {kind} AS kind, start, start + len(m) AS stop FROM (
  SELECT doc_id, i, m[i] AS m, g[i] AS g, list_sum([len(x) for x in between[1:i]]) + coalesce(list_sum([len(x) for x in m[1:i - 1]]), 0) AS start
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, {pattern}) AS m, regexp_extract_all(t, {pattern}{group}) AS g, regexp_split_to_array(t, {pattern}) AS between FROM d))) WHERE len(g) >= {least}"""


_ASSIGN = """'([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""


@query(
    "base_secret_spans",
    f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_each(_ASSIGN, 0, 12, ", 2")} UNION ALL {_each("'AKIA[A-Z0-9]+'", 1, 18)} UNION ALL {_each("'[0-9a-f]+'", 2, 16)}),
a AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
      string_agg((['assign', 'access', 'hex'])[kind + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, kind) AS s FROM f GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(s, '')) AS base_sha256 FROM d LEFT JOIN a USING (doc_id)""",
)
def base_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base spans of op4_secret_scan, which SQL can state."""
    return op4_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


#: SQL of crc32 of ids as text, by the table of its polynomial: k(doc_id, crc).
CRC = """tb(i, c, n) AS (SELECT i, CAST(i AS UBIGINT), 0 FROM range(256) AS x(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS UBIGINT), c >> 1) ELSE c >> 1 END, n + 1 FROM tb WHERE n < 8),
t256 AS (SELECT list(c ORDER BY i) AS tab FROM tb WHERE n = 8),
r(doc_id, s, p, c) AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), ''), 0, CAST(4294967295 AS UBIGINT) FROM documents
  UNION ALL SELECT doc_id, s, p + 1, xor(tab[CAST(xor(c, CAST(ascii(substr(s, p + 1, 1)) AS UBIGINT)) & 255 AS INT) + 1], c >> 8) FROM r, t256 WHERE p < len(s)),
k AS (SELECT doc_id, xor(c, CAST(4294967295 AS UBIGINT)) AS crc FROM r WHERE p = len(s))"""


@query("op9_lm_scoring")
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the whole backoff automaton; ``lm_scores`` compares them, rounded, with SQL."""
    docs = table(spark, sf_dir, "documents")
    return scoring.score(docs, scoring.in_part(F.col("doc_id"), 7, 2)).withColumnRenamed("key", "doc_id")


@query(
    "lm_scores",
    rf"""WITH RECURSIVE {CRC},
d AS (SELECT doc_id, crc % 7 = 2 AS held_out, list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' end') AS w FROM documents JOIN k USING (doc_id)),
e AS (SELECT doc_id, held_out, i, w[i] AS t, CASE WHEN i > 1 THEN w[i - 1] ELSE ' end' END AS x FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d)),
c AS (SELECT t, count(*) AS c FROM e WHERE NOT held_out GROUP BY t),
f AS (SELECT sum(c)::DOUBLE AS n, count(*) AS v, (count(*) FILTER (c = 1) + 1) / (sum(c) + 2)::DOUBLE AS unknown FROM c),
arc AS (SELECT p.x, p.t, (m - 0.5::DOUBLE) / c.c AS p FROM (SELECT x, t, count(*) AS m FROM e WHERE NOT held_out GROUP BY ALL) AS p JOIN c ON c.t = p.x WHERE m >= 2),
st AS (SELECT x, (1 - sum(arc.p)) / (1 - sum((1 - unknown) * c.c / n)) AS fail FROM arc JOIN c ON c.t = arc.t, f GROUP BY x),
s AS (SELECT doc_id, c.c, log10(coalesce(arc.p, coalesce(fail, 1) * CASE WHEN c.c > 0 THEN (1 - unknown) * c.c / n ELSE unknown END)) AS l, log10((coalesce(c.c, 0) + 1) / (n + v + 1)) AS b
      FROM e LEFT JOIN c ON c.t = e.t LEFT JOIN arc ON arc.x = e.x AND arc.t = e.t LEFT JOIN st ON st.x = e.x, f)
SELECT doc_id, any_value(held_out) AS held_out, count(*) AS n_tokens, count(s.c) AS n_known, CAST(any_value(n) AS BIGINT) AS train_tokens, round(sum(b), 4) AS base_score, round(sum(l), 4) AS score FROM s JOIN d USING (doc_id), f GROUP BY doc_id""",
)
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9_lm_scoring with its sums rounded to four places."""
    return op9_lm_scoring(spark, sf_dir).withColumns({c: F.round(c, 4) for c in ("base_score", "score")})


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by the model fitted on the rows that are not held out. A fitted model is beyond SQL: tests hold accuracy on rows held out, and features against a plain version."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = scoring.in_part(F.col("doc_id"), 3, 1)
    found = toxicity.score(docs, labels, ~held_out).withColumnRenamed("key", "doc_id")
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query(
    "op2_minhash_dedup",
    r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM d),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
l AS (SELECT x.doc_id AS a, y.doc_id AS b FROM e AS x JOIN e AS y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept FROM s JOIN (SELECT a AS doc_id, min(b) AS c FROM r GROUP BY a) USING (doc_id)
""",
)
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of each document among near duplicates."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query(
    "op8_substring_dedup",
    r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT rid, doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS s FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT s, min(doc_id) AS least FROM g GROUP BY s),
h AS (SELECT DISTINCT rid, unnest(range(i, i + 13)) AS p FROM g JOIN m USING (s) WHERE least < doc_id),
k AS (SELECT d.rid, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) AS d LEFT JOIN h USING (rid, p) WHERE h.p IS NULL GROUP BY d.rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (rid)
""",
)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each document that are left without passages that stand in an earlier one."""
    out = substrings.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
