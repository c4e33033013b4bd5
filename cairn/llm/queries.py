"""Queries of the training-data operators and, where SQL can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .url_filter import TWO_LABELS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import taken

    return taken(_table(spark, sf_dir, "documents"))


def op2_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_file import read_shards, write_shards

    return read_shards(write_shards(_table(spark, sf_dir, "documents")))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import BASE_KINDS, find_pii, joined

    pii = F.col("pii")
    found = find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    base = F.filter(pii, lambda s: s["kind"].isin(*BASE_KINDS))
    of_kind = lambda k: F.filter(pii, lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    scores = F.array_join(F.transform(pii, lambda s: s["score"].cast("string")), ",")
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(pii).alias("spans"), scores.alias("scores"), F.size(pii).cast("long").alias("n_spans"))


def op4_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls, outcomes_of

    out = filter_urls(_table(spark, sf_dir, "pages"), outcomes_of(_table(spark, sf_dir, "labels")))
    return out.select("page_id", "host", "path", "rule", "verdict", *[F.round(c, 6).alias(c) for c in ("bad_bound", "bad_mean", "domain_mean", "suffix_mean")])


def op5_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import search

    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0).select("vec_id"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import held_out, identify, train

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op7_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import digests, round_trip

    return digests(round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op8_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .recurrent_lm import score_texts

    return score_texts(_table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge

    return judge(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fim import restore, transform

    out, form = F.col("fim.output"), F.col("fim.form")
    made = transform(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", F.sha2(out, 256).alias("output_sha256"), F.sha2(restore(out, form), 256).alias("restored_sha256"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import contamination

    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .align import link_summary

    return link_summary(_table(spark, sf_dir, "documents")).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit() and callable(f)}


OP1_SQL = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k FROM documents),
per AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][CAST((i - 1) % 3 + 1 AS INT)] AS DOUBLE) AS w, source_size * 2.0::DOUBLE AS cap FROM per),
fill AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
  row_number() OVER (ORDER BY cap / w, i) AS place FROM w),
capped AS (SELECT *, level * w >= cap AS capped FROM fill),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE w * (SELECT level FROM capped WHERE NOT capped ORDER BY place LIMIT 1) END AS target FROM capped),
line AS (SELECT row_number() OVER () AS id, doc_id, d.source, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
blocks AS (SELECT source, CAST(ceil(floor(target) / 1024) AS BIGINT) AS n FROM t),
laid AS (SELECT *, CAST(coalesce(sum(n) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a, greatest(1, length(bin(CAST(sum(n) OVER () AS BIGINT)))) AS m FROM blocks),
points AS (SELECT source, CAST('0b' || reverse(lpad(bin(a + x), CAST(m AS INT), '0')) AS BIGINT) AS slot FROM (SELECT *, unnest(range(n)) AS x FROM laid WHERE n > 0)),
slots AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS block FROM points),
pieces AS (SELECT id, source, p * source_size + cum AS f, least(p * source_size + cum + size, CAST(floor(target) AS BIGINT)) AS e FROM line, (VALUES (0), (1)) v(p)),
cut AS (SELECT id, source, f, e, unnest(range(f // 1024, (e - 1) // 1024 + 1)) AS block FROM pieces WHERE f < e),
mixed AS (SELECT id, sum(least(e, (cut.block + 1) * 1024) - greatest(f, cut.block * 1024)) AS taken, min(slot) AS first_slot, count(*) AS n_pieces FROM cut JOIN slots ON cut.block = slots.block AND cut.source IS NOT DISTINCT FROM slots.source GROUP BY id)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, first_slot, coalesce(n_pieces, 0) AS n_pieces FROM line LEFT JOIN mixed USING (id)
"""

_TWO = f"regexp_matches(two, '{TWO_LABELS}')"


def _strength_sql(children: str, parent: str) -> str:
    return f"""(SELECT CASE WHEN den IS NULL OR den <= 0 THEN 2.0 ELSE (1 - least(greatest(num / den, 1e-4), 0.999)) / least(greatest(num / den, 1e-4), 0.999) END FROM (
      SELECT sum(a_ - k_ * k_ / n_ - v_ * (j_ - 1)) AS num, sum(v_ * (n_ - q_ / n_ - (j_ - 1))) AS den FROM (
        SELECT *, k_ / n_ * (1 - k_ / n_) AS v_ FROM (
          SELECT CAST(sum(n) AS DOUBLE) AS n_, CAST(sum(k) AS DOUBLE) AS k_, CAST(count(*) AS DOUBLE) AS j_, CAST(sum(n * n) AS DOUBLE) AS q_, sum(CAST(k * k AS DOUBLE) / n) AS a_
          FROM {children} WHERE n > 0 GROUP BY {parent}))))"""


OP4_SQL = f"""
WITH cut AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
parts AS (SELECT *, string_split(host, '.') AS l, list_aggregate(list_slice(string_split(host, '.'), -2, -1), 'string_agg', '.') AS two FROM cut),
named AS (SELECT page_id, host, path,
  CASE WHEN regexp_matches(host, '^[0-9.]+$') THEN host WHEN {_TWO} THEN list_aggregate(list_slice(l, -3, -1), 'string_agg', '.') ELSE two END AS domain,
  CASE WHEN regexp_matches(host, '^[0-9.]+$') THEN host WHEN {_TWO} THEN two ELSE l[-1] END AS suffix FROM parts),
outcomes AS (SELECT doc_id, CASE WHEN toxic IS NULL AND quality IS NULL THEN NULL WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END AS bad FROM labels),
hosts AS (SELECT host, domain, suffix, count(bad) AS n, coalesce(sum(bad), 0) AS k FROM named LEFT JOIN outcomes ON page_id = doc_id GROUP BY host, domain, suffix),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k, 0 AS one FROM hosts GROUP BY suffix),
fit AS (SELECT (SELECT (sum(k) + 1.0) / (sum(n) + 2.0) FROM hosts) AS p0, {_strength_sql('suffixes', 'one')} AS ms, {_strength_sql('domains', 'suffix')} AS md, {_strength_sql('hosts', 'domain')} AS mh),
s AS (SELECT suffix, (k + ms * p0) / (n + ms) AS m FROM suffixes, fit),
d AS (SELECT domain, m AS suffix_mean, (k + md * m) / (n + md) AS m FROM domains JOIN s USING (suffix), fit),
h AS (SELECT host, n, mh, p0, suffix_mean, m AS domain_mean, (k + mh * m) / (n + mh) AS m FROM hosts JOIN d USING (domain), fit),
ruled AS (SELECT *, host = 'net' OR host LIKE '%.net' AS net, host = 'example.net' OR host LIKE '%.example.net' AS exnet, host = 'example.com' OR host LIKE '%.example.com' AS excom, host = 'org' OR host LIKE '%.org' AS org FROM cut),
rules AS (SELECT page_id, host, path, CASE WHEN exnet AND starts_with(path, '/en/') THEN 'example.net/en/' WHEN excom AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN org AND starts_with(path, '/fr/') THEN 'org/fr/' WHEN net AND starts_with(path, '/') THEN 'net/' END AS rule FROM ruled)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN m - 1.6448536269514722 * sqrt(m * (1 - m) / (n + mh + 1)) > least(0.5, 2.0 * p0) THEN 'block' ELSE 'allow' END AS verdict,
  round(m - 1.6448536269514722 * sqrt(m * (1 - m) / (n + mh + 1)), 6) AS bad_bound, round(m, 6) AS bad_mean, round(domain_mean, 6) AS domain_mean, round(suffix_mean, 6) AS suffix_mean
FROM rules JOIN h USING (host)
"""

OP9_SQL = """
WITH RECURSIVE words AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS s FROM words),
sizes AS (SELECT id, count(*) AS n FROM sets GROUP BY id),
shared AS (SELECT a.id AS u, b.id AS v, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.id < b.id GROUP BY ALL),
half AS (SELECT u, v FROM shared JOIN sizes x ON u = x.id JOIN sizes y ON v = y.id WHERE 100 * k >= 75 * (x.n + y.n - k)),
links AS (SELECT u, v FROM half UNION ALL SELECT v, u FROM half),
reach AS (SELECT id, id AS r FROM words UNION SELECT reach.id, links.v FROM reach JOIN links ON reach.r = links.u),
least AS (SELECT reach.id, min(doc_id) AS component_id FROM reach JOIN words ON reach.r = words.id GROUP BY reach.id),
degree AS (SELECT u AS id, count(*) AS n_links FROM links GROUP BY u)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links FROM words JOIN least USING (id) LEFT JOIN sizes USING (id) LEFT JOIN degree USING (id)
"""

OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS l, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
u AS (SELECT *, len(l) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(l) + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(l) + 1) AS b, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM d),
p AS (SELECT *, array_to_string(list_slice(l, 1, least(a, b)), '') AS prefix, array_to_string(list_slice(l, least(a, b) + 1, greatest(a, b)), '') AS middle, array_to_string(list_slice(l, greatest(a, b) + 1, n), '') AS suffix,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h4 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s FROM (SELECT *, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
places AS (SELECT id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM windows))),
found AS (SELECT id, places.k, i, item FROM places JOIN windows ON places.s = windows.s AND places.k = windows.k),
hits AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT id, k, i FROM found)) GROUP BY id),
items AS (SELECT id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM found GROUP BY id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (id) LEFT JOIN items USING (id)
"""

ORACLE_SQL = {"op12_decontaminate": OP12_SQL, "op11_fill_in_middle": OP11_SQL, "op9_near_duplicates": OP9_SQL, "op1_mix_sources": OP1_SQL, "op4_url_reputation": OP4_SQL}
