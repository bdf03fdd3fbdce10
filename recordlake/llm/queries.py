"""Queries of the training-data operators, and their SQL twins where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.registry.base import Group, table

G = Group()


def crc(mod: int):
    """The remainder of the CRC-32 of the id as text; null ids count as 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod)), F.lit(0))


@G.add("op9_language_id")
def language_id(spark, sf_dir):
    from recordlake.llm import langid

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = langid.train(docs, crc(4) != 2)
    return langid.identify(docs.select("doc_id", (crc(4) == 2).alias("held_out"), "text"), net).drop("text")


@G.add("op10_ngram_jaccard_join")
def ngram_jaccard_join(spark, sf_dir):
    from recordlake.llm import jaccard

    return jaccard.near_components(table(spark, sf_dir, "documents"))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, md5(text), '')) AS k FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS w FROM per),
stops AS (SELECT *, sum(s) OVER () * 150 AS total,
    coalesce(sum(2 * s) OVER (ORDER BY 2 * s * (10 // w), source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
    sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY 2 * s * (10 // w), source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o
  FROM weighed),
shares AS (SELECT *, max(CASE WHEN (total - 100 * stopped) * w <= 200 * s * o
    THEN (total - 100 * stopped)::DOUBLE / (100 * o)::DOUBLE END) OVER () AS share FROM stops),
targets AS (SELECT source, s, coalesce(least((2 * s)::DOUBLE, share * w), (2 * s)::DOUBLE) AS target FROM shares),
cuts AS (SELECT d.doc_id, d.size, t.s, t.target, floor(t.target + 0.5)::BIGINT AS budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
whole AS (SELECT *, CASE WHEN s > 0 THEN budget // s ELSE 0 END AS w FROM cuts)
SELECT doc_id, size, s AS source_size, target, (w * size + greatest(0, least(size, budget - w * s - ahead)))::BIGINT AS taken FROM whole"""


@G.add("op3_mix_sources", MIX_SQL)
def mix_sources(spark, sf_dir):
    from recordlake.llm import mixing
    from recordlake.session import stored

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("size"))
    # The sizes, a few bytes a row, are counted once.
    return mixing.mix(stored(docs, "sizes")).select("doc_id", "size", "source_size", "target", "taken")


@G.add("op4_token_id_codes")
def token_id_codes(spark, sf_dir):
    from recordlake.llm import dac, tokens
    from recordlake.session import work_path

    path = work_path(spark, "codes")
    dac.write(table(spark, sf_dir, "documents"), path, tokens.tokenizer_path("byte_bpe_50k.json"), 2)
    return dac.read(spark, path).withColumnRenamed("key", "doc_id")


@G.add("op6_benchmark_leaks")
def benchmark_leaks(spark, sf_dir):
    from recordlake.llm import leaks

    found = leaks.annotate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


QUALITY_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
m AS (SELECT w.doc_id, t, words, lines, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 5 * n_symbols <= n_words
  AND (n_dup_lines <= 1 OR 10 * n_dup_lines <= 3 * len(lines))
  AND 10 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) >= 7 * n_words
  AND 2 * length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) <= word_chars
  AND 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•]'))) <= 9 * len(lines)
  AND 10 * len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) <= 3 * len(lines) AS kept FROM f"""


@G.add("op8_quality_cascade", QUALITY_SQL)
def quality_cascade(spark, sf_dir):
    from recordlake.llm import quality

    return quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


BOILERPLATE_SQL = r"""
WITH p AS (SELECT page_id, row_number() OVER () AS r, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
  list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
    '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g'),
    '(?i)</?(a|abbr|b|code|em|i|small|span|strong|sub|sup|u)\b[^>]*>', '', 'g'), '<[^>]*>', chr(10), 'g'), chr(10)),
    lambda x: trim(regexp_replace(x, '[ \t\r\x0b\x0c]+', ' ', 'g'), ' ')), lambda x: x <> '') AS lines FROM pages),
l AS (SELECT r, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM p),
n AS (SELECT host, line, count(DISTINCT r) AS n FROM l GROUP BY host, line),
t AS (SELECT host, count(*) AS total FROM p GROUP BY host),
bad AS (SELECT host, line FROM n JOIN t USING (host) WHERE n >= 3 AND n > 0.3::DOUBLE * total),
k AS (SELECT l.r, count(*) AS n, string_agg(l.line, chr(10) ORDER BY l.i) AS kept FROM l LEFT JOIN bad ON l.host = bad.host AND l.line = bad.line
  WHERE bad.line IS NULL GROUP BY l.r)
SELECT p.page_id, p.host, len(p.lines)::BIGINT AS n_lines, (len(p.lines) - coalesce(k.n, 0))::BIGINT AS n_dropped,
  sha256(coalesce(k.kept, '')) AS kept_sha256 FROM p LEFT JOIN k ON p.r = k.r"""


@G.add("op7_site_boilerplate", BOILERPLATE_SQL)
def site_boilerplate(spark, sf_dir):
    from recordlake.llm import boilerplate

    made = boilerplate.drop_boilerplate(table(spark, sf_dir, "pages"))
    return made.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)).drop("kept")


@G.add("op2_hmm_scores")
def hmm_scores(spark, sf_dir):
    from recordlake.llm import hmm

    return hmm.score(table(spark, sf_dir, "documents").select("doc_id", "text"), crc(10) == 0)


@G.add("op5_token_counts")
def token_counts(spark, sf_dir):
    from recordlake.llm import tokencounts, tokens

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokencounts.count_tokens(docs, tokens.tokenizer_path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@G.add("op1_suffix_dedup")
def suffix_dedup(spark, sf_dir):
    from recordlake.llm import suffixes

    return suffixes.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


@G.add("op11_simhash_near_dedup")
def simhash_near_dedup(spark, sf_dir):
    from recordlake.llm import simhash

    return simhash.near_components(table(spark, sf_dir, "documents"))


SPELLING_SQL = r"""
WITH RECURSIVE
bits AS (SELECT range AS i, range AS c, 0 AS k FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crcs AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
named AS (SELECT run, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs WHERE length(run) >= 7),
hashed AS (SELECT run, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2),
    lambda i: (('0x' || substr(x, 2 * i + 1, 2))::BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM named, crcs),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM hashed),
w AS (SELECT word, count(*) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
gone AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
pairs AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM gone a JOIN gone b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT g.word, g.n, w.word, w.n FROM gone g JOIN w ON g.rest = w.word
  UNION SELECT w.word, w.n, g.word, g.n FROM gone g JOIN w ON g.rest = w.word),
best AS (SELECT word, count(*) AS n_near, min({'m': -near_n, 'near': near}) AS b FROM pairs GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b.m >= 10 * w.n THEN b.near END AS form,
    CASE WHEN -b.m >= 10 * w.n THEN -b.m END AS form_n FROM w LEFT JOIN best USING (word)),
ways AS (SELECT word, word AS root, 0 AS k FROM formed UNION ALL SELECT ways.word, form, k + 1 FROM ways JOIN formed ON formed.word = root WHERE form IS NOT NULL)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN (SELECT word, arg_max(root, k) AS root FROM ways GROUP BY word) USING (word)"""


@G.add("op13_spelling_variants", SPELLING_SQL)
def spelling_variants(spark, sf_dir):
    from recordlake.llm import spelling

    docs = table(spark, sf_dir, "documents").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(spelling.runs(F.col("text"), 7)).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    word = F.when(h % 31 == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    counts = docs.select(word.alias("word")).where(F.length("word") >= 7).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    return spelling.variants(counts)


NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, list_inner_product(a.x, v.x)::BIGINT AS score
  FROM v a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""


@G.add("op12_hard_negatives", NEGATIVES_SQL)
def hard_negatives(spark, sf_dir):
    from recordlake.llm import negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.whole_numbers(table(spark, sf_dir, "embeddings"), 256, label=label, vector="embedding")
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)
