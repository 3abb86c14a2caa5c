"""DuckDB SQL oracles, one per registered query (same column names).

Where the Spark job applies rules DuckDB cannot express (Java regex, VARIANT),
the oracle states the expected value by construction from the generator key
``k`` (see ``shapekit.sources.derived``).
"""

from __future__ import annotations

# The answer generator, DuckDB dialect: fields of the whole text, then the variants.
_FIELDS = """string_split(text, chr(10)) AS ln, ln[1] AS t,
  list_concat(list_filter(ln[2:], lambda x, i: i % 2 = 1), CASE WHEN idx % 8 = 3 THEN ['unlisted item'] ELSE []::VARCHAR[] END) AS ing,
  list_filter(ln[2:], lambda x, i: i % 2 = 0) AS st"""

_GEN = f"""
d AS (SELECT *, {_FIELDS} FROM (SELECT doc_id AS idx, source AS model, text,
        CASE WHEN doc_id % 50 = 20 THEN 10 ELSE doc_id % 10 END AS k FROM documents)),
j AS (SELECT *, to_json(t)::VARCHAR AS jt, to_json(ing)::VARCHAR AS ji,
        concat(left(to_json(st)::VARCHAR, -1), CASE WHEN len(st) > 0 THEN ',' ELSE '' END) AS js FROM d),
b AS (SELECT *, concat('{{"title":',jt,',"ingredients":',ji,',"steps":',js,'"x"]}}') AS g FROM j),
a AS (SELECT *, CASE k
   WHEN 0 THEN g
   WHEN 1 THEN concat('```json',chr(10),g,chr(10),'```')
   WHEN 2 THEN concat('Sure, here it is: ',g,' Done.')
   WHEN 3 THEN concat('{{',translate(substring(g,2,length(g)-2),'{{}}','()'))
   WHEN 4 THEN translate(text,'{{}}','()')
   WHEN 5 THEN concat('{{"title":',jt,',"ingredients":',ji,',"steps":',js,'"x"],}}')
   WHEN 6 THEN concat('{{"note":1,"title":',jt,',"ingredients":',ji,',"steps":',js,'"x"]}}')
   WHEN 7 THEN concat('{{"title":',jt,',"ingredients":',ji,',"directions":',js,'"x"]}}')
   WHEN 8 THEN concat('{{"title":',jt,',"ingredients":',jt,',"steps":',to_json(st)::VARCHAR,'}}')
   WHEN 9 THEN concat('{{"title":',jt,',"ingredients":',ji,',"steps":',js,'"a }} b {{ ',chr(92),'" c"]}} {{}}')
   ELSE '{{}}' END AS raw FROM b)
"""

# Phase runs: 'before' k = idx % 10, 'after' k = (idx + idx div 10) % 10.
_RUNS = f"""
p AS (SELECT *, {_FIELDS} FROM (SELECT ph.phase, doc_id AS idx, source AS model, text,
             CASE WHEN doc_id % 50 = 20 THEN 10 WHEN ph.phase = 'before' THEN doc_id % 10 ELSE (doc_id + doc_id // 10) % 10 END AS k
      FROM documents, (VALUES ('before'), ('after')) ph(phase)))
"""

_STRIP = "trim({x}, chr(32) || chr(9) || chr(10) || chr(13))"
_FOLD = ("lower(trim(regexp_replace(translate({x}, '‘’‚‛“”„‟´`', " + "'" * 9 + '""""' + "'" * 5 + "), '\\s+', ' ', 'g')))")

# Fields of accepted answers: variant 10 is empty, 9 ends with another step, 8 has no extra step.
_OT = "CASE WHEN k = 10 THEN '' ELSE t END"
_OI = "CASE WHEN k = 10 THEN []::VARCHAR[] ELSE ing END"
_OS = "CASE WHEN k = 10 THEN []::VARCHAR[] WHEN k = 9 THEN list_append(st, 'a } b { \" c') ELSE list_append(st, 'x') END"

_STRICT_REASON = ("CASE WHEN k IN (3,4) THEN 'no_json' WHEN k = 5 THEN 'invalid_json' "
                  "WHEN k IN (6,7,10) THEN 'bad_keys' END")
_LENIENT_REASON = ("CASE WHEN k IN (3,4) THEN 'no_json' WHEN k = 5 THEN 'invalid_json' "
                   "WHEN k = 8 THEN 'bad_types' END")
_API_REASON = (f"CASE WHEN k = 4 AND {_STRIP.format(x='text')} = '' THEN 'empty' WHEN k IN (3,4) THEN 'non_json' "
               "WHEN k IN (5,9) THEN 'invalid_json' END")


def W(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n"


ORACLE: dict = {}

ORACLE["strip_fences"] = W(_GEN) + f"""
SELECT idx, CASE k WHEN 1 THEN g ELSE {_STRIP.format(x='raw')} END AS clean FROM a"""

ORACLE["json_block"] = W(_GEN) + r"""
SELECT idx, CASE WHEN k IN (0,1,2) THEN g WHEN k IN (3,4) THEN NULL WHEN k = 9 THEN left(raw, -3) ELSE raw END AS json_str,
  CASE k WHEN 3 THEN 'unclosed' WHEN 4 THEN 'no_brace' END AS detail FROM a"""

ORACLE["validate_strict"] = W(_GEN) + f"""
SELECT idx, model, {_STRICT_REASON} AS reason,
  CASE k WHEN 3 THEN 'unclosed' WHEN 4 THEN 'no_brace' END AS detail,
  ({_STRICT_REASON}) IS NULL AS ok FROM a"""

ORACLE["key_diff"] = W(_GEN) + """
SELECT idx, CASE WHEN k IN (3,4,5) THEN NULL WHEN k = 7 THEN 'steps' WHEN k = 10 THEN 'ingredients,steps,title' ELSE '' END AS missing,
  CASE WHEN k IN (3,4,5) THEN NULL WHEN k = 6 THEN 'note' WHEN k = 7 THEN 'directions' ELSE '' END AS extra
FROM a"""

ORACLE["validate_lenient"] = W(_GEN) + f"""
SELECT idx, {_LENIENT_REASON} AS reason, ({_LENIENT_REASON}) IS NULL AS ok, k = 10 AS is_vacuous FROM a"""

ORACLE["invalid_detail"] = W(_GEN) + """
SELECT idx, CASE WHEN idx % 11 = 10 THEN NULL ELSE concat('invalid_json: ',
  ['trailing comma', 'bare word', 'bad escape', 'wrong bracket', 'missing comma', 'missing colon', 'missing value', 'missing key',
   'control character', 'bare word'][idx % 11 + 1], ' at ', length(g) - 1 + [0, 5, 7, 7, 1, 5, 5, 1, 7, 1][idx % 11 + 1]) END AS reason FROM a"""

ORACLE["lenient_project"] = W(_GEN) + f"""
SELECT idx, {_OT} AS title, array_to_string({_OI}, '|') AS ingredients, array_to_string({_OS}, '|') AS steps
FROM a WHERE ({_LENIENT_REASON}) IS NULL"""

ORACLE["outer_slice"] = W(_GEN) + r"""
SELECT idx, CASE WHEN k IN (0,1,2) THEN g WHEN k IN (3,4) THEN NULL ELSE raw END AS slice FROM a"""

ORACLE["validate_api"] = W(_GEN) + f"""
SELECT idx, {_API_REASON} AS reason, ({_API_REASON}) IS NULL AS ok,
  CASE WHEN ({_API_REASON}) IS NOT NULL THEN NULL ELSE (k = 8 AND t <> '') END AS coerced FROM a"""

ORACLE["coerce_list"] = W(_GEN) + f"""
SELECT idx, {_OT} AS title, CASE WHEN k = 8 THEN t ELSE array_to_string({_OI}, '|') END AS ingredients,
  CASE WHEN k = 7 THEN '' WHEN k = 8 THEN array_to_string(st, '|') ELSE array_to_string({_OS}, '|') END AS steps,
  (k = 8 AND t <> '') AS coerced
FROM a WHERE ({_API_REASON}) IS NULL"""

ORACLE["format_flags"] = W(_GEN) + """
SELECT idx, k IN (0,3,5,6,7,8,9,10) AS starts_brace, k IN (0,5,6,7,8,9,10) AS ends_brace,
  k = 1 AS has_fence, k IN (2,9) AS extra_text FROM a"""

ORACLE["quarantine"] = W(_GEN) + f"""
SELECT idx, CASE WHEN ({_STRICT_REASON}) IS NULL THEN 'ok' ELSE 'failed' END AS status,
  {_STRICT_REASON} AS reason FROM a"""

ORACLE["inline_errors"] = W(_GEN) + f"""
SELECT idx, CASE WHEN ({_API_REASON}) IS NULL THEN {_OT} ELSE '' END AS title,
  CAST(CASE WHEN ({_API_REASON}) IS NOT NULL THEN 0 WHEN k = 8 THEN (t <> '')::INT ELSE len({_OI}) END AS BIGINT)
    AS n_ingredients,
  {_API_REASON} AS error, CASE WHEN ({_API_REASON}) IS NOT NULL THEN idx END AS index FROM a"""

ORACLE["extraction_summary"] = W(_RUNS) + f"""
SELECT model, phase, count(*) AS total,
  count(*) FILTER (WHERE ({_STRICT_REASON}) IS NULL) AS extracted,
  count(*) FILTER (WHERE ({_STRICT_REASON}) IS NOT NULL) AS failures
FROM p GROUP BY model, phase"""

ORACLE["failure_histogram"] = W(_RUNS) + f"""
SELECT phase, {_LENIENT_REASON} AS reason, count(*) AS n FROM p
WHERE ({_LENIENT_REASON}) IS NOT NULL GROUP BY ALL"""

ORACLE["quality_rates"] = W(_RUNS) + f"""
SELECT model, phase, count(*) AS n,
  round(avg(CASE WHEN k IN (3,4,5) THEN 0.0 ELSE 1.0 END), 6) AS syntax_rate,
  round(avg(CASE WHEN ({_STRICT_REASON}) IS NULL THEN 1.0 ELSE 0.0 END), 6) AS strict_rate,
  round(avg(CASE WHEN ({_LENIENT_REASON}) IS NULL THEN 1.0 ELSE 0.0 END), 6) AS lenient_rate,
  round(avg(CASE WHEN ({_LENIENT_REASON}) IS NULL THEN CAST(l.quality = 1 AS INT)::DOUBLE END), 6)
    AS semantic_rate
FROM p LEFT JOIN labels l ON l.doc_id = p.idx GROUP BY model, phase"""

# ---- pair building ------------------------------------------------------------------

_STRUCT = """
g AS (SELECT l_orderkey AS id, to_json(list(p_name ORDER BY l_linenumber, p_name, l_returnflag))::VARCHAR AS ing,
             to_json(list(concat('Pack line ', l_linenumber, ' flag ', l_returnflag) ORDER BY l_linenumber, p_name, l_returnflag))::VARCHAR AS dir
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
s AS (SELECT o_orderkey AS id, concat(' Order ', o_orderkey, ' ', o_orderpriority, ' ') AS title,
             coalesce(g.ing, '[]') AS ingredients, coalesce(g.dir, '[]') AS directions
      FROM orders LEFT JOIN g ON g.id = o_orderkey),
c AS (SELECT CAST(id AS VARCHAR) AS id, title,
             CASE WHEN id % 17 = 4 THEN NULL WHEN id % 50 = 7 THEN left(ingredients, length(ingredients) - 1)
                  WHEN id % 50 = 8 THEN concat(left(ingredients, -1), CASE WHEN ingredients = '[]' THEN '' ELSE ',' END, 'None,]')
                  ELSE ingredients END AS ingredients,
             CASE WHEN id % 17 = 4 THEN NULL ELSE directions END AS directions, id AS nid
      FROM s WHERE id % 13 <> 3 AND id % 19 <> 6 AND id % 23 <> 9)
"""

_TEXTS = """
tt AS (SELECT doc_id, CASE WHEN doc_id % 31 = 9 THEN concat(text, ' add acid 5 drops') ELSE text END AS text FROM documents),
tx AS (SELECT doc_id AS id, CASE WHEN doc_id % 97 = 5 THEN concat(text, ' (revised)') ELSE text END AS text
       FROM tt)
"""

_BL = "(25, 261, 380, 383, 585, 619, 674, 844, 851, 899, 902, 993, 994, 999)"

_CAUSE = f"""CASE WHEN nid < 50 OR nid >= 100000 THEN 'out_of_range' WHEN nid IN {_BL} THEN 'blacklist' WHEN nid NOT IN (SELECT id FROM tx) THEN 'no_text'
  WHEN nid % 17 = 4 OR nid % 50 = 7 THEN 'unparsable' END"""

ORACLE["csv_tolerant"] = W(_STRUCT) + "SELECT id, title, ingredients, directions FROM c"

ORACLE["project_present"] = W(_STRUCT) + "SELECT id, title FROM c"

ORACLE["keep_only"] = W(_STRUCT) + "SELECT id, directions FROM c"

ORACLE["csv_audit"] = W(_STRUCT) + """
SELECT CASE WHEN id % 13 = 3 OR id % 19 = 6 THEN 'too_long' WHEN id % 23 = 9 THEN 'unterminated_quote' ELSE 'ok' END AS status,
  count(*) AS n FROM s GROUP BY ALL"""

ORACLE["table_profile"] = W(_STRUCT) + """
SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_cols, 'id,title,ingredients,directions' AS col_names FROM c"""

ORACLE["sanitize"] = W(_STRUCT) + """
SELECT id, coalesce(ingredients, '') AS ingredients, coalesce(directions, '') AS directions FROM c"""

ORACLE["strip_ws"] = W(_STRUCT) + "SELECT id, trim(title) AS title FROM c"

ORACLE["tagged_text"] = W(_TEXTS) + """
SELECT doc_id AS id, text FROM tt
UNION ALL SELECT doc_id AS id, concat(text, ' (revised)') AS text FROM tt WHERE doc_id % 97 = 5"""

ORACLE["marker_audit"] = W(_TEXTS) + r"""
, ln AS (SELECT unnest(string_split(concat('ID ', doc_id, ' - ', text), chr(10))) AS v FROM tt
         UNION ALL SELECT unnest(string_split(concat('ID ', doc_id, ' - ', text), chr(10))) FROM tt WHERE doc_id % 97 = 5),
c AS (SELECT regexp_matches(v, '^(?i)i?id\s+\d+')::INT AS a, len(regexp_extract_all(v, '(?i)i?id\s+\d+')) AS l FROM ln)
SELECT count(*) AS n_lines, sum(a)::BIGINT AS n_anchored, sum(l)::BIGINT AS n_loose, count(*) FILTER (WHERE a <> l) AS n_disagree FROM c"""

ORACLE["last_wins"] = W(_TEXTS) + "SELECT id, text FROM tx"

ORACLE["slice_rows"] = W(_STRUCT) + """
SELECT nid AS id, title FROM c WHERE nid >= 50 AND nid < (SELECT max(nid) - 99 FROM c)"""

ORACLE["blacklist_anti"] = W(_STRUCT) + f"SELECT nid AS id FROM c WHERE nid NOT IN {_BL}"

ORACLE["blacklist_audit"] = W(_STRUCT) + f"""
SELECT b.id, b.id IN (SELECT nid FROM c) AS hit
FROM (SELECT unnest([25, 261, 380, 383, 585, 619, 674, 844, 851, 899, 902, 993, 994, 999])::BIGINT AS id) b"""

ORACLE["semi_text"] = W(_STRUCT, _TEXTS) + "SELECT nid AS id FROM c WHERE nid IN (SELECT id FROM tx)"

ORACLE["list_cell"] = W(_STRUCT) + """
SELECT c.id, CASE WHEN nid % 17 = 4 OR nid % 50 = 7 THEN NULL ELSE coalesce(len(l.items), 0) + (nid % 50 = 8)::INT END::BIGINT AS n_items,
  CASE WHEN nid % 17 = 4 OR nid % 50 = 7 THEN NULL ELSE coalesce(array_to_string(l.items, '|'), '') END AS items
FROM c LEFT JOIN (SELECT l_orderkey, list(p_name ORDER BY l_linenumber, p_name, l_returnflag) AS items
                  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey) l ON l.l_orderkey = c.nid"""

ORACLE["unparsable"] = W(_STRUCT) + "SELECT id FROM c WHERE nid % 17 = 4 OR nid % 50 = 7"

_GOLD = """
gl AS (SELECT l_orderkey AS id, list(p_name ORDER BY l_linenumber, p_name, l_returnflag) AS ing,
              list(concat('Pack line ', l_linenumber, ' flag ', l_returnflag) ORDER BY l_linenumber, p_name, l_returnflag) AS dir
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
gj AS (SELECT o_orderkey AS id, to_json({'title': concat('Order ', o_orderkey, ' ', o_orderpriority),
                                        'ingredients': coalesce(gl.ing, []::VARCHAR[]),
                                        'directions': coalesce(gl.dir, []::VARCHAR[])})::VARCHAR AS json
       FROM orders LEFT JOIN gl ON gl.id = o_orderkey)
"""

ORACLE["target_json"] = W(_GOLD) + "SELECT id, json FROM gj"

_PAIRS = W(_STRUCT, _TEXTS, _GOLD) + f"""
SELECT c.nid AS id, tx.text, CASE WHEN c.nid % 50 = 8 THEN concat(regexp_extract(gj.json, '^(.*"ingredients":\\[.*?)\\],"directions":', 1),
    CASE WHEN contains(gj.json, '"ingredients":[]') THEN 'null' ELSE ',null' END, regexp_extract(gj.json, '\\],"directions":.*$')) ELSE gj.json END AS json
FROM c JOIN tx ON tx.id = c.nid JOIN gj ON gj.id = c.nid
WHERE ({_CAUSE}) IS NULL"""

ORACLE["pair_join"] = _PAIRS
ORACLE["pairs_roundtrip"] = _PAIRS

ORACLE["removal_report"] = W(_STRUCT, _TEXTS) + f"""
, r AS (SELECT coalesce({_CAUSE}, 'kept') AS cause FROM c)
SELECT cause, count(*) AS n FROM r GROUP BY cause
UNION ALL SELECT 'in_range', count(*) FROM r WHERE cause <> 'out_of_range'
UNION ALL SELECT 'removed', count(*) FROM r WHERE cause NOT IN ('kept', 'out_of_range')"""

ORACLE["json_sink"] = W(_GEN) + f"""
SELECT idx, {_API_REASON} AS reason, CASE WHEN ({_API_REASON}) IS NULL THEN {_OT} END AS title,
  CASE WHEN ({_API_REASON}) IS NULL THEN array_to_string(CASE WHEN k = 7 THEN [] WHEN k = 8 THEN st ELSE {_OS} END, '|') END AS steps FROM a"""

ORACLE["append_jsonl"] = W(_GEN) + f"""
SELECT r.run_id, count(*) AS n, count(DISTINCT idx) AS n_index FROM a, (VALUES ('r1'), ('r2')) r(run_id)
WHERE ({_LENIENT_REASON}) IS NULL GROUP BY r.run_id"""

ORACLE["append_plain"] = W(_GEN) + f"""
SELECT 'r1' AS run_id, idx, {_OT} AS title, md5(text) AS input_md5 FROM a WHERE ({_LENIENT_REASON}) IS NULL"""

# ---- positions, splits, set checks -------------------------------------------------------

ORACLE["prompt_index"] = """
SELECT row_number() OVER (ORDER BY lang, doc_id) - 1 AS idx, doc_id FROM documents"""

ORACLE["head_tail_union"] = """
(SELECT doc_id, 'head' AS part FROM documents ORDER BY doc_id LIMIT 50)
UNION ALL (SELECT doc_id, 'tail' AS part FROM documents ORDER BY doc_id DESC LIMIT 100)"""

_SPLIT = """
sp AS (SELECT doc_id, text, CASE WHEN row_number() OVER (ORDER BY md5(concat(doc_id, '42')))
          <= ceil(0.1 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM documents)
"""

ORACLE["split_hash"] = W(_SPLIT) + "SELECT doc_id, split FROM sp"

_NORM = f"md5({_FOLD.format(x='text')})"

ORACLE["leak_check"] = W(_SPLIT) + f"""
, k AS (SELECT split, 'id' AS kind, CAST(doc_id AS VARCHAR) AS key FROM sp
        UNION ALL SELECT split, 'text', {_NORM} FROM sp)
SELECT kind, key, count(*) FILTER (WHERE split = 'train') AS n_train,
       count(*) FILTER (WHERE split = 'test') AS n_eval
FROM k GROUP BY kind, key
HAVING count(*) FILTER (WHERE split = 'train') > 0 AND count(*) FILTER (WHERE split = 'test') > 0"""

ORACLE["length_buckets"] = "SELECT doc_id, CAST(floor(n_chars / 500) AS BIGINT) AS bucket FROM documents"

# ---- training examples -------------------------------------------------------------------

_TOK = "regexp_extract_all({x}, '[A-Za-z0-9_]+|[^A-Za-z0-9_\\s]')"
_IDS = ("list_transform(" + _TOK + ", lambda t: (('0x' || substr(md5(t), 1, 8))::BIGINT % 31997 + 3))")
_SYS = "Extract a JSON object with keys title, ingredients, steps. Answer with JSON only."

_EX = W(_GOLD) + f"""
, e AS (SELECT d.doc_id AS id,
          concat('<|im_start|>system', chr(10), '{_SYS}', '<|im_end|>', chr(10),
                 '<|im_start|>user', chr(10), d.text, '<|im_end|>', chr(10)) AS head, gj.json
        FROM documents d JOIN gj ON gj.id = d.doc_id),
f AS (SELECT id, concat(head, '<|im_start|>assistant', chr(10)) AS prompt,
             concat(head, '<|im_start|>assistant', chr(10), json, '<|im_end|>', chr(10)) AS fulltext FROM e),
t AS (SELECT id, len({_TOK.format(x='prompt')}) AS prefix_len, {_IDS.format(x='fulltext')} AS ids FROM f)
"""

ORACLE["render_chat"] = """
SELECT conv_id, string_agg(concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)), '' ORDER BY turn)
  AS rendered FROM conversations GROUP BY conv_id"""

ORACLE["token_len"] = f"SELECT doc_id, CAST(len({_TOK.format(x='text')}) AS BIGINT) AS n_tokens FROM documents"

ORACLE["token_user"] = """
SELECT doc_id, len(string_split(text, ' '))::BIGINT AS n_tokens,
  list_sum(list_transform(string_split(text, ' '), lambda w: length(w)))::BIGINT AS id_sum FROM documents"""

ORACLE["pad_truncate"] = f"""
WITH t AS (SELECT doc_id, {_IDS.format(x='text')} AS ids FROM documents)
SELECT doc_id, CAST(64 AS BIGINT) AS len, CAST(CASE WHEN len(ids) >= 64 THEN ids[64] ELSE 0 END AS BIGINT) AS last_id,
  CAST(greatest(0, 64 - len(ids)) + len(list_filter(ids[1:64], lambda x: x = 0)) AS BIGINT) AS n_pad FROM t"""

ORACLE["train_examples"] = _EX + """
SELECT id, CAST(prefix_len AS BIGINT) AS prefix_len, CAST(len(ids) AS BIGINT) AS full_len,
  CAST(least(len(ids), 512) AS BIGINT) AS n_attn, md5(array_to_string(ids[1:512], ',')) AS ids_md5 FROM t"""

ORACLE["mask_prefix"] = _EX + """
SELECT id, CAST(least(prefix_len, 512) + len(list_filter(ids[least(prefix_len, 512) + 1:512], lambda x: x = -100))
  AS BIGINT) AS n_masked, CAST(512 AS BIGINT) AS n_labels FROM t"""

ORACLE["mask_audit"] = _EX + """
SELECT count(*) AS n, round(avg(CASE WHEN len(ids) > 512 THEN 1.0 ELSE 0.0 END), 6) AS truncated_share,
  round(avg(CASE WHEN prefix_len >= least(len(ids), 512) THEN 1.0 ELSE 0.0 END), 6) AS fully_masked_share,
  round(avg((512 - least(len(ids), 512)) / 512), 6) AS pad_share FROM t"""

ORACLE["token_budget"] = _EX + """
SELECT id, CAST(greatest(256, least(1200, 4096 - prefix_len - 8)) AS BIGINT) AS budget FROM t"""

# ---- comparison and audits -----------------------------------------------------------------

ORACLE["outputs_load"] = W(_RUNS) + f"""
SELECT idx, model, CASE WHEN ({_LENIENT_REASON}) IS NULL THEN 'result' ELSE 'failure' END AS kind,
  {_LENIENT_REASON} AS reason, CASE WHEN ({_LENIENT_REASON}) IS NULL THEN NULL ELSE k IN (3,4) END AS json_str_null
FROM p WHERE phase = 'after'"""

ORACLE["outputs_array"] = ORACLE["outputs_load"]

_FAILS = """
f AS (SELECT phase, model, idx, 'syntax' AS chk, t AS title FROM p WHERE k IN (3,4,5)
      UNION ALL SELECT phase, model, idx, 'structure', t FROM p
        WHERE (phase = 'before' AND k IN (6,7,10)) OR (phase = 'after' AND k = 8)
      UNION ALL SELECT phase, model, idx, 'semantic', t FROM p JOIN labels l ON l.doc_id = p.idx
        WHERE k NOT IN (3,4,5,8) AND l.quality <> 1),
grp AS (SELECT DISTINCT phase, model, c.chk FROM p, (VALUES ('syntax'), ('structure'), ('semantic')) c(chk))
"""

ORACLE["ledger_parse"] = W(_RUNS, _FAILS) + """
SELECT g.phase, g.model, g.chk AS "check", count(f.idx) AS declared, count(f.idx) AS n_listed
FROM grp g LEFT JOIN f ON f.phase = g.phase AND f.model = g.model AND f.chk = g.chk
GROUP BY g.phase, g.model, g.chk"""

ORACLE["ledger_reconcile"] = W(_RUNS, _FAILS) + f"""
, fn AS (SELECT *, {_FOLD.format(x='title')} AS nt FROM f),
kept AS (SELECT * FROM fn WHERE idx % 29 <> 7 AND NOT (model = 'src1' AND chk = 'semantic')),
listing AS (SELECT phase, model, chk, nt FROM kept UNION ALL SELECT phase, model, chk, nt FROM kept WHERE idx % 37 = 3),
lc AS (SELECT phase, model, chk, nt, count(*) AS l FROM listing GROUP BY ALL),
sc AS (SELECT phase, model, chk, nt, count(*) AS s FROM fn WHERE idx % 23 <> 0 GROUP BY ALL),
res AS (SELECT DISTINCT phase, model, {_FOLD.format(x='t')} AS nt FROM p
        WHERE (phase = 'before' AND k NOT IN (3,4,5,6,7,10)) OR (phase = 'after' AND k NOT IN (3,4,5,8))),
m AS (SELECT phase, model, chk, nt, coalesce(l, 0) AS l, coalesce(s, 0) AS s, res.nt IS NOT NULL AS r
      FROM lc FULL JOIN sc USING (phase, model, chk, nt) LEFT JOIN res USING (phase, model, nt)),
head AS (SELECT * FROM grp WHERE NOT (model = 'src1' AND chk = 'semantic')),
n AS (SELECT phase, model, chk, head.phase IS NOT NULL AS has_head, sum(coalesce(l, 0))::BIGINT AS listed, sum(coalesce(s, 0))::BIGINT AS stored,
        sum(coalesce(least(l, s), 0))::BIGINT AS listed_stored, sum(coalesce(greatest(l - s, 0), 0))::BIGINT AS listed_unstored,
        sum(coalesce(greatest(s - l, 0), 0))::BIGINT AS stored_unlisted, sum(coalesce(greatest(l - 1, 0), 0))::BIGINT AS listed_again,
        sum(CASE WHEN r THEN l ELSE 0 END)::BIGINT AS listed_in_results
      FROM m FULL JOIN head USING (phase, model, chk) GROUP BY ALL),
e AS (SELECT *, CASE WHEN has_head THEN listed + (model = 'src3' AND chk = 'structure')::BIGINT END AS declared FROM n)
SELECT phase, model, chk AS "check", declared, listed, stored, listed_stored, listed_unstored, stored_unlisted, listed_again, listed_in_results,
  coalesce(declared, 0) <> listed AS count_mismatch, coalesce(declared, 0) <> stored AS stored_mismatch FROM e"""

ORACLE["missing_outputs"] = W(_RUNS) + "SELECT model, idx FROM p WHERE phase = 'before' AND k IN (3,4,5,6,7,10)"

ORACLE["compare_runs"] = W(_RUNS) + """
, q AS (SELECT model, idx, max(CASE WHEN phase = 'before' AND idx % 41 <> 3 THEN k END) AS kb,
               max(CASE WHEN phase = 'after' AND idx % 43 <> 5 THEN k END) AS ka FROM p GROUP BY model, idx),
s AS (SELECT model, kb NOT IN (3,4,5,6,7,10) AS ok_a, ka NOT IN (3,4,5,8) AS ok_b FROM q WHERE kb IS NOT NULL OR ka IS NOT NULL)
SELECT model, CASE WHEN ok_a IS NULL THEN 'only_b' WHEN ok_b IS NULL THEN 'only_a'
  WHEN NOT ok_a AND ok_b THEN 'fixed' WHEN ok_a AND NOT ok_b THEN 'broken'
  WHEN ok_a THEN 'unchanged_ok' ELSE 'unchanged_fail' END AS status, count(*) AS n FROM s GROUP BY ALL"""

ORACLE["gold_score"] = W(_RUNS) + f"""
, o AS (SELECT idx, {_OT} AS ot, {_OI} AS oi, {_OS} AS os, k, st,
          CASE WHEN idx % 7 = 2 THEN concat(t, ' (gold)') WHEN idx % 7 = 1 THEN replace(t, ' ', '  ') ELSE t END AS gt,
          CASE WHEN idx % 4 = 1 THEN ing[2:] WHEN idx % 4 = 2 THEN list_append(ing, 'salt') ELSE ing END AS gi,
          CASE WHEN idx % 6 = 5 THEN st ELSE list_append(st, 'x') END AS gs
        FROM p WHERE phase = 'before' AND k NOT IN (3,4,5,8)),
c AS (SELECT *, len(list_distinct(oi)) AS no, len(list_distinct(gi)) AS ng,
        len(list_intersect(list_distinct(oi), list_distinct(gi)))::DOUBLE AS shared FROM o),
r AS (SELECT *, CASE WHEN no > 0 THEN shared / no ELSE 0.0 END AS pr, CASE WHEN ng > 0 THEN shared / ng ELSE 0.0 END AS re FROM c)
SELECT idx, {_FOLD.format(x='ot')} = {_FOLD.format(x='gt')} AS title_match,
  round(pr, 6)::DOUBLE AS item_precision, round(re, 6)::DOUBLE AS item_recall,
  round(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0.0 END, 6)::DOUBLE AS item_f1,
  os = gs AS steps_equal,
  CAST(CASE WHEN k = 10 THEN length(array_to_string(gs, chr(10)))
       WHEN idx % 6 = 5 THEN length(os[-1]) + (len(st) > 0)::INT
       ELSE levenshtein(os[-1], gs[-1]) END AS BIGINT) AS steps_edit
FROM r"""

ORACLE["input_drift"] = "SELECT doc_id AS idx FROM documents WHERE doc_id % 37 = 11 AND contains(text, ' the ')"

ORACLE["grounding"] = W(_RUNS) + f"""
, it AS (SELECT model, text, unnest({_OI}) AS item FROM p WHERE phase = 'before' AND k NOT IN (3,4,5,8))
SELECT model, count(*) AS n_items, count(*) FILTER (WHERE contains(lower(text), lower(item))) AS n_found,
  round(count(*) FILTER (WHERE contains(lower(text), lower(item))) / count(*), 6) AS share
FROM it GROUP BY model"""

_PIV = W(_RUNS) + f"""
, r AS (SELECT model, phase, round(avg(CASE WHEN ({_LENIENT_REASON}) IS NULL THEN 1.0 ELSE 0.0 END), 6) AS rate
        FROM p GROUP BY model, phase),
v AS (SELECT model, max(CASE WHEN phase = 'before' THEN rate END) AS "before",
             max(CASE WHEN phase = 'after' THEN rate END) AS "after" FROM r GROUP BY model),
pv AS (SELECT model, "before", "after", round("after" - "before", 6) AS delta,
         CASE WHEN (1 - "before") > 0 THEN round(((1 - "before") - (1 - "after")) / (1 - "before"), 6) END AS error_cut
       FROM v)
"""

ORACLE["phase_pivot"] = _PIV + 'SELECT model, "before", "after", delta, error_cut FROM pv'

ORACLE["rank_improvement"] = _PIV + """
SELECT model, "before" AS base_rate, delta AS gain,
  CAST(rank() OVER (ORDER BY "before" DESC) AS BIGINT) AS rank_base,
  CAST(rank() OVER (ORDER BY delta DESC) AS BIGINT) AS rank_gain FROM pv"""

ORACLE["field_stats"] = W(_RUNS) + f"""
, o AS (SELECT model, {_OT} AS t, {_OI} AS oi, {_OS} AS os FROM p WHERE phase = 'before' AND k NOT IN (3,4,5,8)),
rep AS (SELECT model, count(*) FILTER (WHERE c > 1) AS repeated_titles
        FROM (SELECT model, t, count(*) AS c FROM o GROUP BY model, t) GROUP BY model)
SELECT o.model, count(*) AS n, count(*) FILTER (WHERE t = '') AS empty_titles, count(DISTINCT t) AS distinct_titles,
  round(avg(len(oi)), 6) AS avg_ingredients, count(*) FILTER (WHERE len(oi) = 0) AS empty_ingredients,
  round(avg(len(os)), 6) AS avg_steps, count(*) FILTER (WHERE len(os) = 0) AS empty_steps,
  max(rep.repeated_titles) AS repeated_titles
FROM o JOIN rep ON rep.model = o.model GROUP BY o.model"""

ORACLE["title_match"] = W(_RUNS) + f"""
, o AS (SELECT phase, model, {_FOLD.format(x=_OT)} AS nt FROM p WHERE k NOT IN (3,4,5,8)),
a AS (SELECT DISTINCT model, nt FROM o WHERE phase = 'before'),
b AS (SELECT DISTINCT model, nt FROM o WHERE phase = 'after')
SELECT a.model, count(*) AS titles_a, count(b.nt) AS titles_both
FROM a LEFT JOIN b ON a.model = b.model AND a.nt = b.nt GROUP BY a.model"""

ORACLE["title_fallback"] = f"""
WITH d AS (SELECT doc_id AS idx, {_FOLD.format(x="string_split(text, chr(10))[1]")} AS nt FROM documents),
a AS (SELECT idx AS k, nt FROM d WHERE idx % 11 <> 4),
b AS (SELECT CASE WHEN idx % 5 = 0 THEN idx + 10000000 ELSE idx END AS k, nt FROM d WHERE idx % 13 <> 6),
ra AS (SELECT * FROM a WHERE k NOT IN (SELECT k FROM b)),
rb AS (SELECT * FROM b WHERE k NOT IN (SELECT k FROM a)),
n AS (SELECT nt, coalesce(x, 0) AS x, coalesce(y, 0) AS y FROM (SELECT nt, count(*) AS x FROM ra GROUP BY nt) FULL JOIN
      (SELECT nt, count(*) AS y FROM rb GROUP BY nt) USING (nt) WHERE nt <> '')
SELECT k AS key_a, k AS key_b, 'by_key' AS status FROM a WHERE k IN (SELECT k FROM b)
UNION ALL SELECT ra.k, rb.k, 'by_title' FROM n JOIN ra USING (nt) JOIN rb USING (nt) WHERE x = 1 AND y = 1
UNION ALL SELECT k, NULL, CASE WHEN x > 0 AND y > 0 THEN 'ambiguous' ELSE 'only_a' END FROM ra LEFT JOIN n USING (nt) WHERE NOT coalesce(x = 1 AND y = 1, false)
UNION ALL SELECT NULL, k, CASE WHEN x > 0 AND y > 0 THEN 'ambiguous' ELSE 'only_b' END FROM rb LEFT JOIN n USING (nt) WHERE NOT coalesce(x = 1 AND y = 1, false)"""

ORACLE["prompt_fingerprint"] = """
SELECT source AS model, CAST(2 AS BIGINT) AS n_runs, count(DISTINCT concat(coalesce(lang, '?'), drift)) AS n_fingerprints
FROM (SELECT source, lang, unnest(['before', CASE WHEN doc_id % 29 = 3 THEN 'v2' ELSE 'before' END]) AS drift FROM documents)
GROUP BY source"""

# ---- scoring with stubs -------------------------------------------------------------------

_SC = """
s1 AS (SELECT doc_id AS idx, length(text) AS n, length(text) % 10 AS k1, (length(text) // 10) % 10 AS k2 FROM documents)
"""

ORACLE["score_batch"] = W(_SC) + """
SELECT idx, CASE WHEN k1 IN (3,4) THEN 'no_json' WHEN k1 = 5 THEN 'invalid_json' WHEN k1 IN (6,7) THEN 'bad_keys' END
  AS reason, k1 NOT IN (3,4,5,6,7) AS ok FROM s1"""

ORACLE["score_resume"] = """
WITH d AS (SELECT doc_id AS idx, coalesce(text, '') AS t, length(coalesce(text, '')) % 10 AS k1 FROM documents)
SELECT idx, CASE WHEN t IN (SELECT t FROM d WHERE idx % 3 <> 0) THEN 'first' ELSE 'second' END AS run,
  CASE WHEN k1 IN (3,4) THEN 'no_json' WHEN k1 = 5 THEN 'invalid_json' WHEN k1 IN (6,7) THEN 'bad_keys' END AS reason,
  k1 NOT IN (3,4,5,6,7) AS ok FROM d"""

ORACLE["score_retry"] = W(_SC) + """
SELECT idx, CASE WHEN k1 IN (3,4,5,6,7) THEN 2 ELSE 1 END::BIGINT AS n_calls,
  CASE WHEN k1 IN (3,4,5,6,7) THEN 2 ELSE 1 END::BIGINT AS last FROM s1"""

ORACLE["pick_attempt"] = W(_SC) + """
, q AS (SELECT idx, CASE WHEN k1 NOT IN (3,4,5,6,7) THEN 1 ELSE 2 END AS attempt,
          CASE WHEN k1 NOT IN (3,4,5,6,7) THEN k1 ELSE k2 END AS k,
          CASE WHEN k1 IN (3,4,5,6,7) THEN 2 ELSE 1 END AS n_attempts FROM s1)
SELECT idx, attempt::BIGINT AS attempt, k NOT IN (3,4,5,6,7) AS ok,
  CASE WHEN k IN (3,4) THEN 'no_json' WHEN k = 5 THEN 'invalid_json' WHEN k IN (6,7) THEN 'bad_keys' END AS reason,
  n_attempts::BIGINT AS n_attempts FROM q"""

ORACLE["service_retry"] = W(_SC) + """
, q AS (SELECT idx, n % 11 = 10 AS perm, n % 7 AS nf, k1 IN (0,1,2,6,7,8) AS good FROM s1)
SELECT idx, CASE WHEN NOT perm AND nf < 5 AND good THEN 'ok' ELSE 'error' END AS status,
  CASE WHEN perm THEN 1 WHEN nf < 5 AND good THEN nf + 1 ELSE 5 END::BIGINT AS attempts,
  CASE WHEN perm THEN 'permanent' WHEN nf < 5 AND good THEN NULL ELSE 'exhausted' END AS error_kind,
  CASE WHEN perm THEN 0.0 WHEN nf < 5 AND good THEN (2 ^ (nf + 1) - 2)::DOUBLE ELSE 62.0 END AS waited FROM q"""

# ---- streams --------------------------------------------------------------------------------

ORACLE["stream_quality"] = W(_GEN) + f"""
SELECT model, count(*) AS total, count(*) FILTER (WHERE ({_STRICT_REASON}) IS NULL) AS extracted,
  count(*) FILTER (WHERE ({_STRICT_REASON}) IS NOT NULL) AS failures FROM a GROUP BY model"""

ORACLE["stream_sink"] = W(_GEN) + f"""
SELECT idx, model, CASE WHEN ({_STRICT_REASON}) IS NULL THEN 'ok' ELSE 'failed' END AS status, {_STRICT_REASON} AS reason FROM a"""

ORACLE["stream_assemble"] = W(_GEN) + r"""
SELECT idx, CASE WHEN k IN (0,1,2) THEN g WHEN k IN (3,4) THEN NULL WHEN k = 9 THEN left(raw, -3) ELSE raw END AS json_str,
  CASE WHEN k IN (3,4) THEN 'no_json' ELSE 'complete' END AS status FROM a"""

ORACLE["require_nonempty"] = W(_GEN) + """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE """ + _STRIP.format(x="raw") + """ = '') AS n_blank FROM a"""

ORACLE["split_threshold"] = """
SELECT doc_id, CASE WHEN ('0x' || substr(md5(concat(doc_id, '42')), 1, 8))::BIGINT / 4294967296.0 < 0.1
  THEN 'test' ELSE 'train' END AS split FROM documents"""
