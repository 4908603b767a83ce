"""The queries opN_<name> over the driver's tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import collocations, exact_dedup, importance, kneser_ney, language_id, line_dedup, mixing, piece_bpe, quality_rules, sharding, simhash, suffix_dedup, url_filter
from .common import table

#: The rules of the url query.
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
#: Every site gets the same share of the mix.
MIX_WEIGHTS = {f"src{i}": 1.0 for i in range(20)}
#: Sites that share a line before it counts as boilerplate.
MIN_SITES = 5
SHARDS = 24


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_filter.Rule.parse(v, r) for v, r in URL_RULES]
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules, "page_id", "url")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS)
    return mixed.select("doc_id", "copy", "source", "text", "shuffle_key")


def op3_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    proto = piece_bpe.read_model(tokenizer_path())
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    told = piece_bpe.encode(docs, proto).select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"))
    back = piece_bpe.decode(told, proto)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_passages(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), MIN_SITES)
    return out.select("doc_id", "n_lines", "n_removed", "text")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = language_id.identify(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, share=50, top=2000)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, least_words=20, longest=1, keep=["doc_id"])
    return out.select("doc_id", "n_features", "weight", "score", "rank")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = r"""
WITH u AS (
  SELECT page_id, coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '') AS h,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), v AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
r(rh, rp, verdict) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
b AS (
  SELECT v.*, rh || rp AS rule, r.verdict AS rv,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rh) DESC NULLS LAST, length(rp) DESC) AS n
  FROM v LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT page_id, host, path, rule, coalesce(rv, 'allow') AS verdict FROM b WHERE n = 1
"""

OP2_SQL = f"""
WITH w(source, weight) AS (VALUES {", ".join(f"('{s}', {w}::DOUBLE)" for s, w in MIX_WEIGHTS.items())}),
z AS (SELECT d.source, sum(strlen(coalesce(text, '')))::DOUBLE AS n, any_value(weight) AS weight FROM documents d JOIN w USING (source) GROUP BY d.source),
r AS (SELECT source, weight / (SELECT sum(weight) FROM z WHERE n > 0) * (SELECT sum(n) FROM z WHERE n > 0) / n AS rate FROM z WHERE n > 0),
p AS (SELECT source, k, exp(k * ln(rate) - rate - sum(CASE WHEN k = 0 THEN 0.0 ELSE ln(k) END) OVER (PARTITION BY source ORDER BY k)) AS p
      FROM r, generate_series(0, 300) AS g(k) WHERE k <= ceil(rate + 12 * sqrt(rate) + 40)),
c AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM p),
l AS (SELECT source, list(cdf) AS cdf FROM c GROUP BY source),
u AS (SELECT *, CAST('0x' || substr(md5('{mixing.SEED}:' || doc_id), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0 AS u FROM documents),
n AS (SELECT u.doc_id, u.source, u.text, CASE WHEN l.source IS NULL THEN 0 ELSE len(list_filter(l.cdf, lambda x: x <= u.u)) END AS n FROM u JOIN l ON u.source = l.source),
e AS (SELECT doc_id, source, text, unnest(range(n)) AS copy FROM n)
SELECT doc_id, CAST(copy AS INTEGER) AS copy, source, text, md5('{mixing.SEED}/order:' || doc_id || ':' || copy) AS shuffle_key FROM e
"""

OP4_SQL = f"""
WITH t AS (SELECT doc_id, {_LOWER} AS n FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY n) AS keep_id, CAST(count(*) OVER (PARTITION BY n) AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256
FROM t
"""

_LEVEL, _LEAST = quality_rules._tests(quality_rules.STRATA, quality_rules.RISK, quality_rules.DELTA)
_CUTS = {r: f"[{', '.join(map(str, cuts))}]::DOUBLE[]" for r, cuts in quality_rules.PATH.items()}
OP5_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN lang IN {quality_rules.STRATA} THEN lang ELSE '*' END AS stratum FROM documents),
w AS (SELECT doc_id, stratum, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM t),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
twin AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS rep FROM twin, range(8) AS r(o) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
c AS (SELECT doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
             coalesce(rep, 0) AS n_repeat_words, greatest(coalesce(n_lines, 0), 1) AS lines, greatest(len(w), 1) AS words, len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_upper FROM w LEFT JOIN l USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, n_symbols / words AS symbols_per_word, n_dup_lines / lines AS duplicate_line_share, n_repeat_words / words AS repeated_word_share,
             word_chars / words AS long_words, -word_chars / words AS short_words, n_upper / greatest(word_chars, 1) AS shouting FROM c),
h AS (SELECT f.*, (SELECT count(*) FROM range({quality_rules.STEPS}) AS s(j) WHERE NOT ({" OR ".join(f"{r} > ({cuts})[j + 1]" for r, cuts in _CUTS.items())})) AS first
      FROM f WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
name AS (SELECT stratum, CASE WHEN count(*) < {_LEAST} THEN '{quality_rules.POOL}' ELSE stratum END AS test FROM h GROUP BY stratum),
k AS (SELECT test, j, count(*) AS n, count(*) FILTER (WHERE first <= j) AS k FROM h JOIN name USING (stratum), range({quality_rules.STEPS}) AS s(j) GROUP BY test, j),
p AS (SELECT test, j, k > n * {quality_rules.RISK} AS above, list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({quality_rules.RISK}) + (n - i) * ln(1 - {quality_rules.RISK})))) AS p FROM k),
step AS (SELECT stratum, max(j) AS step FROM name JOIN p USING (test) WHERE NOT above AND p <= {_LEVEL} GROUP BY stratum),
v AS (SELECT f.*, concat_ws(',', {", ".join(f"CASE WHEN {r} > ({cuts})[step + 1] THEN '{r}' END" for r, cuts in _CUTS.items())}) AS rejected_by FROM f LEFT JOIN step USING (stratum))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rejected_by = '' AS kept, rejected_by FROM v
"""

OP9_SQL = f"""
WITH l AS (SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
b AS (SELECT line, min(doc_id) AS keeper FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}),
k AS (SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keeper <> l.doc_id) AS n_removed,
             string_agg(l.line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR keeper = l.doc_id) AS text
      FROM l LEFT JOIN b ON l.line = b.line GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN k USING (doc_id)
"""

OP12_SQL = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 4) AS r(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL),
t AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
u AS (SELECT lang, k, phrase, a, cut, array_to_string(w[1:cut], ' ') AS x, array_to_string(w[cut + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
b AS (SELECT u.lang, u.k, u.phrase, u.a, l.n AS l, r.n AS r, (1000000::HUGEINT * u.a * u.a // (l.n::HUGEINT * r.n))::BIGINT AS score, cut
      FROM u JOIN f AS l ON l.lang = u.lang AND l.phrase = x JOIN f AS r ON r.lang = u.lang AND r.phrase = y),
s AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
m AS (SELECT lang, sub, max(a) AS most FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS sub FROM c WHERE k = 3) GROUP BY ALL),
o AS (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank FROM s LEFT JOIN m ON m.lang = s.lang AND m.sub = s.phrase WHERE most IS NULL OR 100 * most < 50 * a)
SELECT o.lang, rank, phrase, a, l, r, t.n, score FROM o JOIN t USING (lang) WHERE rank <= 2000
"""

#: The CRC is the usual one, reflected, by a table of 256 entries made from its polynomial; distinct words are hashed once.
OP13_SQL = rf"""
WITH e AS (SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS crc FROM range(256) AS r(b)),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(w) AS w FROM d),
y AS (SELECT unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
v AS (SELECT w, hex(encode(w)) AS hex FROM (SELECT w FROM x UNION SELECT w FROM y)),
h AS (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(hex) // 2), lambda i: ('0x' || substr(hex, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % {importance.BUCKETS} AS bucket FROM v, e),
s AS (SELECT bucket, count(*) AS s FROM x JOIN h USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM y JOIN h USING (w) GROUP BY bucket),
g AS (SELECT r.bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM s)::DOUBLE + {importance.BUCKETS}) / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t)::DOUBLE + {importance.BUCKETS}))))::BIGINT AS gain
      FROM range({importance.BUCKETS}) AS r(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
z AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM x JOIN h USING (w) JOIN g USING (bucket) GROUP BY doc_id),
k AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{importance.SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN z USING (doc_id)),
o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM k WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM k LEFT JOIN o USING (doc_id)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": OP1_SQL, "op2_mixing": OP2_SQL, "op4_exact_dedup": OP4_SQL, "op5_quality_rules": OP5_SQL, "op9_line_dedup": OP9_SQL, "op12_collocations": OP12_SQL, "op13_importance": OP13_SQL}
