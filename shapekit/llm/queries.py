"""Registered queries of the corpus operators, and the SQL of those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import collocations, decontaminate, embed_dedup, html_extract, lang_id, licenses, mixing, resample, secrets, shingle_join, substring_dedup, token_store, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.language_summary(spark, table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_windows(spark, table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_summary(spark, table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.jaccard_components(spark, table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_summary(spark, table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(spark, table(spark, sf_dir, "pages"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("longest")


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(spark, table(spark, sf_dir, "documents"), tokenizer_path())


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.vector_groups(spark, table(spark, sf_dir, "embeddings"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_summary(spark, table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The rules of the URL query, in the order given.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark, table(spark, sf_dir, "pages"), URL_RULES)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_source_mixing": op3_source_mixing,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_secret_scan": op5_secret_scan,
    "op6_html_extraction": op6_html_extraction,
    "op7_decontamination": op7_decontamination,
    "op8_token_store": op8_token_store,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_url_filter": op12_url_filter,
    "op13_phrase_collocations": op13_phrase_collocations,
}


# ---- SQL of the operators that SQL can express ---------------------------------------------

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"list_filter(string_split_regex({x}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_ALNUM = r"regexp_extract_all({x}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# smallest node reachable over link(a, b), both directions listed
_REACH = "reach(node, r) AS (SELECT a, b FROM link UNION SELECT reach.node, link.b FROM reach JOIN link ON link.a = reach.r)"

_OP2 = f"""
WITH w AS (SELECT doc_id, {_SPACED.format(x="coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
early AS (SELECT g, min(doc_id) AS f FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + o AS p FROM win JOIN early USING (g), range(0, 13) t(o) WHERE f < doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k
         FROM (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS x FROM w) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_OP4 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACED.format(x=_LOW)} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
{_REACH}
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(doc_id, (SELECT min(r) FROM reach WHERE node = doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id)""".replace("both AS", "pair AS").replace("FROM both", "FROM pair")


def _spans_sql(order: int, rule: secrets.Rule) -> str:
    """Spans of one rule: lengths of the pieces between matches and of the matches, summed up."""
    # short hex runs cannot pass the length test, so the length is asked for at once
    re_ = rule.regex.replace("'", "''") if rule.kind != "hex" else f"[0-9a-f]{{{rule.least},}}"
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{re_}')) + 1), lambda i: {{
      'start': (length(array_to_string(string_split_regex(t, '{re_}')[1:i], '')) + length(array_to_string(regexp_extract_all(t, '{re_}')[1:i - 1], '')))::INT,
      'ord': {order}, 'len': length(regexp_extract_all(t, '{re_}')[i])::INT, 'test': length(regexp_extract_all(t, '{re_}', {rule.group})[i])::INT,
      'kind': '{rule.kind}'}}), lambda s: s.test >= {rule.least})"""


_TOLD = "array_to_string(list_transform({x}, lambda y: concat(y.kind, ':', y.start, ':', y.start + y.len)), ',')"
_OP5 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
q AS (SELECT doc_id, list_sort(flatten([{', '.join(_spans_sql(k, r) for k, r in enumerate(secrets.RULES))}])) AS found FROM d)
SELECT doc_id, len(list_filter(found, lambda x: x.ord = 0))::BIGINT AS n_assign, len(list_filter(found, lambda x: x.ord = 1))::BIGINT AS n_access,
  len(list_filter(found, lambda x: x.ord = 2))::BIGINT AS n_hex, sha256({_TOLD.format(x="list_filter(found, lambda x: x.ord < 3)")}) AS base_sha256,
  {_TOLD.format(x="found")} AS spans FROM q"""

_OP7 = f"""
WITH w AS (SELECT doc_id, {_ALNUM.format(x=_LOW)} AS ws FROM documents),
b AS (SELECT item_id, ws, least(10, len(ws)) AS k FROM (SELECT item_id, {_ALNUM.format(x=_LOW)} AS ws FROM benchmark) WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM b)),
dw AS (SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g
       FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM bw))),
h AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(v, ',' ORDER BY v) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS v FROM h) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""

_OP9 = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON len(x.e) = len(y.e) AND x.vec_id <> y.vec_id
         WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
{_REACH}
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, r) AS component_id, vec_id = least(vec_id, r) AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) l ON l.a = vec_id
LEFT JOIN (SELECT node, min(r) AS r FROM reach GROUP BY node) c ON c.node = vec_id"""

_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(hex(w)) + 1, 2), lambda i:
  (16 * (instr('0123456789ABCDEF', hex(w)[i]) - 1) + instr('0123456789ABCDEF', hex(w)[i + 1]) - 1)::BIGINT)),
  lambda c, b: xor(crc_table[(xor(c, b) & 255) + 1], c >> 8))"""
_OP11 = f"""
WITH tab AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x::BIGINT, range(8)), lambda c, i:
  CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END)) AS crc_table),
d AS (SELECT doc_id, {_ALNUM.format(x=_LOW)} AS ws FROM documents),
dw AS (SELECT doc_id, unnest(ws) AS w FROM d),
bw AS (SELECT unnest({_ALNUM.format(x=_LOW)}) AS w FROM benchmark),
word AS (SELECT w, xor({_CRC}, 4294967295) % 10000 AS b FROM (SELECT w FROM dw UNION SELECT w FROM bw), tab),
s AS (SELECT b, count(*) AS s FROM dw JOIN word USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM bw JOIN word USING (w) GROUP BY b),
gain AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM dw) + 10000)::DOUBLE
           / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM bw) + 10000)::DOUBLE)))::BIGINT AS gain
         FROM (SELECT DISTINCT b FROM word) LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
wt AS (SELECT doc_id, floor(sum(gain) / count(*))::BIGINT AS weight FROM dw JOIN word USING (w) JOIN gain USING (b) GROUP BY doc_id),
h AS (SELECT d.doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 9), lambda i: (instr('0123456789abcdef', sha256('2024:' || d.doc_id)[i]) - 1)::BIGINT)),
          lambda x, y: 16 * x + y) AS h FROM d LEFT JOIN wt USING (doc_id)),
sc AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM h),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM sc WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, rank FROM sc
LEFT JOIN (SELECT * FROM r WHERE rank <= (SELECT 10 * count(*) // 100 FROM r)) USING (doc_id)"""

_OP13 = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOW}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, g, count(*) AS f FROM (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS g
        FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 4) t(k))) GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS ws FROM f WHERE k > 1),
part AS (SELECT lang, g, a, j, array_to_string(ws[1:j], ' ') AS x, array_to_string(ws[j + 1:], ' ') AS y FROM c, range(1, 3) t(j) WHERE j < k),
cut AS (SELECT part.lang, part.g, a, j, fx.f AS l, fy.f AS r, ((1000000::HUGEINT * a * a) // (fx.f::HUGEINT * fy.f)) AS score
        FROM part JOIN f fx ON fx.lang = part.lang AND fx.g = x JOIN f fy ON fy.lang = part.lang AND fy.g = y),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, j) AS o FROM cut),
longer AS (SELECT lang, g, max(a) AS m FROM (SELECT lang, array_to_string(ws[i:i + 1], ' ') AS g, a FROM c, range(1, 3) t(i) WHERE k = 3) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN longer USING (lang, g) WHERE o = 1 AND (m IS NULL OR 100 * m < 50 * a)),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept)
SELECT lang, rank, g AS phrase, a, l, r, n, score::BIGINT AS score FROM top JOIN n USING (lang) WHERE rank <= 2000"""

ORACLE: dict[str, str] = {
    "op2_substring_dedup": _OP2,
    "op4_ngram_jaccard_join": _OP4,
    "op5_secret_scan": _OP5,
    "op7_decontamination": _OP7,
    "op9_embedding_near_dedup": _OP9,
    "op11_importance_resampling": _OP11,
    "op13_phrase_collocations": _OP13,
}
