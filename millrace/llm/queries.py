"""The operators' queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import centroids, embeddings, language, lines, mixing, packing, repetition, search, sharding, simhash, substrings, tokens, urls
from millrace.llm.common import word_count

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

MIX_SEED, SHARD_SEED = 17, 23

URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, word_count(F.col("text")), seed=MIX_SEED)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("repeats") * F.col("size")).alias("taken"), "repeats")


SQL["op1_mix"] = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5('{MIX_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), '')), 1, 15) AS BIGINT) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM d GROUP BY source),
f AS (SELECT *, sum(2 * source_size) OVER w - 2 * source_size AS clamped, sum(weight) OVER () - sum(weight) OVER w + weight AS weights,
    1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS budget FROM s
    WINDOW w AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT (budget - CAST(clamped AS DOUBLE)) / CAST(weights AS DOUBLE) AS level FROM f
    WHERE (budget - CAST(clamped AS DOUBLE)) / CAST(weights AS DOUBLE) * weight <= 2 * source_size ORDER BY clamped, level LIMIT 1),
t AS (SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), weight * level) AS target FROM s, l),
p AS (SELECT *, CAST(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS BIGINT) AS whole FROM t),
q AS (SELECT *, CAST(round(target - CAST(whole * source_size AS DOUBLE)) AS BIGINT) AS due FROM p),
k AS (SELECT source, key, sum(size) AS here FROM d GROUP BY source, key),
r AS (SELECT k.source, key, here, sum(here) OVER (PARTITION BY k.source ORDER BY key ROWS UNBOUNDED PRECEDING) - here AS before FROM k),
c AS (SELECT r.source, key AS cut, (due - before) * 2 >= here AS with_cut FROM r JOIN q ON r.source IS NOT DISTINCT FROM q.source
    WHERE due > 0 AND before < due AND before + here >= due),
m AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.whole + CASE WHEN key < cut OR (key = cut AND with_cut) THEN 1 ELSE 0 END AS repeats
    FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target, CAST(repeats * size AS BIGINT) AS taken, CAST(repeats AS BIGINT) AS repeats FROM m"""


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def _covered(k: int, marked: str) -> str:
    grams = " || ' ' || ".join(f"lead(word, {j}) OVER o" if j else "word" for j in range(k))
    return f"""(SELECT r, count(*) AS n, CAST(sum(length(word)) AS BIGINT) AS chars FROM
      (SELECT DISTINCT r, unnest(range(i, i + {k})) AS i FROM
        (SELECT r, i, row_number() OVER (PARTITION BY r, gram ORDER BY i) AS occ, count(*) OVER (PARTITION BY r, gram) AS times FROM
          (SELECT r, i, {grams} AS gram FROM w WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE gram IS NOT NULL)
        WHERE {marked}) JOIN w USING (r, i) GROUP BY r)"""


_GRAMS = sorted(repetition.MAX_GRAM_PERCENT)
_GOOD = " AND ".join([f"dup_line_chars * 100 <= word_chars * {repetition.MAX_LINE_PERCENT}",
                      *(f"dup_chars_{k} * 100 <= word_chars * {repetition.MAX_GRAM_PERCENT[k]}" for k in _GRAMS)])

SQL["op2_repetition"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM
    (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d)),
c AS (SELECT r, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars FROM w GROUP BY r),
l AS (SELECT r, count(*) AS n_dup_lines, CAST(sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS BIGINT) AS dup_line_chars FROM
    (SELECT r, line, row_number() OVER (PARTITION BY r, line ORDER BY i) AS occ FROM
      (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) WHERE occ > 1 GROUP BY r),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(b.n, 0) AS n_repeat_words, coalesce(dup_line_chars, 0) AS dup_line_chars,
    {", ".join(f"coalesce(g{k}.chars, 0) AS dup_chars_{k}" for k in _GRAMS)}
    FROM d LEFT JOIN c USING (r) LEFT JOIN l USING (r) LEFT JOIN {_covered(repetition.BASE_WINDOW, "times > 1")} AS b USING (r)
    {" ".join(f"LEFT JOIN {_covered(k, 'occ > 1')} AS g{k} USING (r)" for k in _GRAMS)})
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND {_GOOD} AS kept FROM m"""


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    found = language.identify(docs.select("doc_id", "text"), known)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id", "kept")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_table(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(substrings.joined_words(F.col("kept_text")), 256).alias("kept_sha256"))


SQL["op8_substrings"] = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d WHERE len(words) >= 20),
g AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 19], ' ')) AS gram FROM s),
l AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS gone FROM l GROUP BY doc_id),
k AS (SELECT d.doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
    list_filter(words, lambda w, i: gone IS NULL OR NOT list_contains(gone, i)) AS kept FROM d LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k"""


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_RULE_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

SQL["op9_urls"] = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULE_VALUES}),
u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path, row_number() OVER () AS n FROM pages),
f AS (SELECT n, max_by(rule_host || rule_path, length(rule_host || rule_path) * 1000 + length(rule_host)) AS rule,
    max_by(rule_verdict, length(rule_host || rule_path) * 1000 + length(rule_host)) AS verdict FROM u JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN f USING (n)"""


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = sharding.shuffle_into_shards(narrow, 8, SHARD_SEED)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


_WHITE = " || ".join(f"chr({ord(c)})" for c in lines.WHITE)

SQL["op11_lines"] = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, row_number() OVER () AS r FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
v AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {lines.MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {lines.MIN_DOCS}),
m AS (SELECT r, doc_id, i, line, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN v USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY r, doc_id"""


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _terms(column: str) -> str:
    return f"""regexp_extract_all(translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""


SQL["op12_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms("text")} AS terms FROM documents),
c AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY ALL),
q AS (SELECT q, item_id, term, count(*) AS times FROM
    (SELECT row_number() OVER () AS q, item_id, unnest({_terms("text")}) AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM t, c GROUP BY term),
s AS (SELECT q, item_id, doc_id, r, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(terms) * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM q JOIN w USING (term) JOIN t USING (term) JOIN d USING (r), c GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s
WHERE score > 0 QUALIFY rank <= 10"""


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    written = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(written, 256).alias("centroid_sha256"))


# Ten rounds, written out. Sums stay far below 2 ** 53, so the floor of a quotient of doubles is exact.
SQL["op13_centroids"] = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS cells FROM embeddings
    WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64),
x AS MATERIALIZED (SELECT r, unnest(cells) AS x, generate_subscripts(cells, 1) AS j FROM v),
s AS (SELECT cells, row_number() OVER (ORDER BY sha256('3:' || vec_id), cells) - 1 AS c FROM v QUALIFY c < 8),
c0 AS MATERIALIZED (SELECT c, unnest(cells) AS y, generate_subscripts(cells, 1) AS j FROM s),
{"".join(f"""d{n} AS MATERIALIZED (SELECT r, c, sum((x - y) * (x - y)) AS d FROM x JOIN c{n} USING (j) GROUP BY r, c),
a{n} AS MATERIALIZED (SELECT r, min_by(c, d * 8 + c) AS c, min(d) AS d FROM d{n} GROUP BY r),
m{n} AS (SELECT c, j, CAST(floor(sum(x) / count(*)) AS BIGINT) AS y FROM a{n} JOIN x USING (r) GROUP BY c, j),
c{n + 1} AS MATERIALIZED (SELECT c, j, coalesce(m{n}.y, c{n}.y) AS y FROM c{n} LEFT JOIN m{n} USING (c, j)),
""" for n in range(11))}
h AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c10 GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a10 JOIN v USING (r) JOIN h USING (c)"""


QUERIES.update({f.__name__: f for f in (op1_mix, op2_repetition, op3_language, op4_simhash, op5_tokens, op6_embeddings, op7_packing, op8_substrings, op9_urls, op10_shards,
                                    op11_lines, op12_search, op13_centroids)})
