"""Registered queries of the text operators and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import read_table

SQL: dict[str, str] = {}

#: (action, host, path) of the url rules
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def held_out(id_col: str = "doc_id"):
    """Rows whose label or language is never learnt from."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.op01_toxicity import fit, score
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").filter(~held_out()).select("doc_id", F.col("toxic").alias("label"))
    model = fit(docs, docs.join(labels, "doc_id"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "vote", "neighbours")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.op02_language_id import fit, predict
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, ~held_out(), model_path())
    return predict(docs, model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.op03_sentencepiece import encode_docs
    return encode_docs(read_table(spark, sf_dir, "documents"), model_path())


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.op06_exact_dedup import grace_dedup
    return grace_dedup(read_table(spark, sf_dir, "documents"))


SQL["op6_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n_points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n_points DESC, doc_id)
"""


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.op07_url_filters import judge_urls
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


SQL["op7_url_filters"] = r"""
WITH p AS (
  SELECT page_id,
         CASE WHEN url LIKE '%://%' THEN
           translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN url LIKE '%://%' THEN
           regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(action, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fit AS (
  SELECT page_id, r.h || r.p AS rule, action,
         row_number() OVER (PARTITION BY page_id ORDER BY length(r.h) + length(r.p) DESC, length(r.h) DESC) AS n
  FROM p JOIN rules r ON (host = r.h OR host LIKE '%.' || r.h) AND starts_with(path, r.p))
SELECT p.page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM p LEFT JOIN fit ON p.page_id = fit.page_id AND n = 1
"""

def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.op04_ngram_join import jaccard_components
    return jaccard_components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL["op4_ngram_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + k - 1], ' ') AS s
  FROM (SELECT doc_id, ws, least(4, len(ws)) AS k, unnest(range(1, len(ws) - least(4, len(ws)) + 2)) AS p
        FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id
      GROUP BY 1, 2),
links AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * c >= 85 * (na.n + nb.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, m AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = d.doc_id
"""


#: a page is asked for again within this many fetches
REFETCH_SPAN = 5000


def warc_records(pages: DataFrame) -> DataFrame:
    """Two records of every page: its response, and a conditional re-fetch some
    fetches later, answered 304 with the validators of that response."""
    digest = F.sha1(F.coalesce("html", F.lit("")))
    base = pages.select("page_id", "url", digest.alias("digest"))
    etag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    first = base.select(
        (F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("type"), "url",
        (F.col("page_id") * 2).alias("moment"), F.lit(200).alias("status"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("etag"), etag,
                     F.lit("age"), F.lit("0")).alias("headers"), "digest")
    wait = F.pmod(F.col("page_id") * 7919, F.lit(REFETCH_SPAN))
    again = base.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("type"), "url",
        ((F.col("page_id") + wait) * 2 + 1).alias("moment"), F.lit(304).alias("status"),
        F.create_map(F.lit("content-type"), F.lit("none"), F.lit("etag"), etag,
                     F.lit("age"), wait.cast("string")).alias("headers"),
        F.lit(None).cast("string").alias("digest"))
    return first.unionByName(again)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.op05_warc import header_lines, resolve_revisits
    out = resolve_revisits(warc_records(read_table(spark, sf_dir, "pages")))
    return out.select("record_id", F.expr("record_id div 2").alias("page_id"), "type", "canonical", "state",
                      "source_id", header_lines("merged").alias("headers"))


SQL["op5_warc"] = r"""
WITH u AS (
  SELECT page_id, sha1(coalesce(html, '')) AS digest,
         regexp_replace(regexp_replace(trim(url), '#(.|\n)*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
  FROM pages),
c AS (
  SELECT page_id, '"' || digest[1:16] || '"' AS etag,
         regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g')
         || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
         || coalesce('?' || nullif(array_to_string(list_sort(list_filter(
              string_split(regexp_extract(rest, '^[^?]*\?((.|\n)*)$', 1), '&'),
              lambda p: p <> '' AND NOT starts_with(p, 'utm_'))), '&'), ''), '') AS canonical
  FROM u),
r AS (
  SELECT page_id * 2 AS record_id, page_id, 'response' AS type, canonical, etag, page_id * 2 AS moment, 0 AS wait FROM c
  UNION ALL
  SELECT page_id * 2 + 1, page_id, 'revisit', canonical, etag,
         (page_id + page_id * 7919 % 5000) * 2 + 1, page_id * 7919 % 5000 FROM c),
j AS (
  SELECT v.*, s.record_id AS src, s.etag AS src_etag
  FROM r v ASOF LEFT JOIN (SELECT * FROM r WHERE type = 'response') s
    ON v.canonical = s.canonical AND v.moment > s.moment
  WHERE v.type = 'revisit')
SELECT record_id, page_id, type, canonical,
       CASE WHEN canonical IS NULL THEN 'unresolvable' WHEN src IS NULL THEN 'no_earlier'
            WHEN etag = src_etag THEN 'resolved' ELSE 'mismatch' END AS state,
       CASE WHEN etag = src_etag THEN src END AS source_id,
       CASE WHEN etag = src_etag THEN
         'age: ' || wait || chr(10) || 'content-type: text/html' || chr(10) || 'etag: ' || etag END AS headers
FROM j
UNION ALL
SELECT record_id, page_id, type, canonical, CASE WHEN canonical IS NULL THEN 'unresolvable' ELSE 'full' END,
       CASE WHEN canonical IS NOT NULL THEN record_id END,
       CASE WHEN canonical IS NOT NULL
            THEN 'age: 0' || chr(10) || 'content-type: text/html' || chr(10) || 'etag: ' || etag END
FROM r WHERE type = 'response'
"""


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.op08_substring_dedup import drop_repeats
    return drop_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


SQL["op8_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, p, array_to_string(ws[p:p + 19], ' ') AS w
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS p FROM d)),
late AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS n FROM g)
         WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, p + o AS p FROM late, range(0, 20) t(o)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS k
         FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) x ON d.doc_id = x.doc_id
"""


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.op09_suffix_dedup import drop_repeated_bytes
    return drop_repeated_bytes(read_table(spark, sf_dir, "documents")).drop("kept")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.op10_decontamination import find_leaks
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


SQL["op10_decontamination"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM benchmark),
ig AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[p:p + k - 1], ' ') AS g
  FROM (SELECT item_id, ws, least(5, len(ws)) AS k, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS p
        FROM i WHERE len(ws) > 0)),
size AS (SELECT item_id, count(*) AS n FROM ig GROUP BY item_id),
dg AS (
  SELECT DISTINCT doc_id, k, array_to_string(ws[p:p + k - 1], ' ') AS g
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p
        FROM w, (SELECT DISTINCT k FROM ig) WHERE len(ws) >= k)),
c AS (SELECT doc_id, item_id, count(*) AS n_common FROM dg JOIN ig USING (k, g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n AS n_shingles, n_common, n_common / n::DOUBLE AS containment
FROM c JOIN size USING (item_id) WHERE n_common * 5 >= n * 4
"""


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.op11_conversation_repair import damage, repair_conversations
    return repair_conversations(damage(read_table(spark, sf_dir, "conversations")))


# Rows after damage, their faults, then the edit lattice row by row: the cheapest edits
# (ties ASCII-least) that end in each state (0 nothing, 1 system, 2 user, 3 assistant).
SQL["op11_conversation_repair"] = r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
h AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) % 20 AS kind
  FROM k),
d AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM h WHERE kind <> 0),
o AS (
  SELECT *, row_number() OVER w AS i, lag(role[1]) OVER w AS before,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS kept
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
f AS (
  SELECT *, CASE WHEN kept = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN kept[-1] IN ('.', '!', '?') THEN 'f' ELSE 't' END AS fault,
         before IS NOT NULL AND before || role[1] NOT IN ('su', 'ua', 'au') AS odd FROM o),
ids AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (
  SELECT ids.conv_id, 0::BIGINT AS i, 0 AS state, {'cost': 0::BIGINT, 'audit': '', 'lines': ''} AS best FROM ids
  UNION ALL
  SELECT conv_id, i, state, min(best) AS best FROM (
    SELECT r.conv_id, r.i, e.state, {
        'cost': s.best.cost + s.ins_cost + e.cost, 'audit': s.best.audit || s.ins || e.letter,
        'lines': s.best.lines || s.ins_lines || CASE e.letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || r.role || ':' || r.text
                 ELSE chr(10) || (CASE e.state WHEN 2 THEN 'user:' ELSE 'assistant:' END) || r.text END} AS best
    FROM (
      SELECT conv_id, i, best, state, 0 AS ins_cost, '' AS ins, '' AS ins_lines FROM walk
      UNION ALL SELECT conv_id, i, best, CASE state WHEN 2 THEN 3 ELSE 2 END, 3, 'I',
                       CASE state WHEN 2 THEN chr(10) || 'assistant:' ELSE chr(10) || 'user:' END FROM walk
      UNION ALL SELECT conv_id, i, best, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:' FROM walk WHERE state <> 2) s
    JOIN f r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1,
    LATERAL (
      SELECT 'D' AS letter, s.state AS state, 4 AS cost
      UNION ALL SELECT 'K', CASE r.role[1] WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, CASE r.fault WHEN 't' THEN 3 ELSE 0 END
        WHERE r.fault IN ('f', 't') AND ((r.role[1] = 's' AND s.state = 0) OR (r.role[1] = 'u' AND s.state <> 2)
                                         OR (r.role[1] = 'a' AND s.state = 2))
      UNION ALL SELECT 'R', CASE s.state WHEN 2 THEN 3 ELSE 2 END, CASE r.fault WHEN 't' THEN 6 ELSE 3 END
        WHERE r.fault IN ('f', 't')) e)
  GROUP BY conv_id, i, state),
done AS (
  SELECT conv_id, min(best) AS best FROM (
    SELECT conv_id, i, state, best FROM walk
    UNION ALL SELECT conv_id, i, 3, {'cost': best.cost + 3, 'audit': best.audit || 'I', 'lines': best.lines || chr(10) || 'assistant:'}
      FROM walk WHERE state = 2
    UNION ALL SELECT conv_id, i, 3, {'cost': best.cost + 6, 'audit': best.audit || 'II',
                                     'lines': best.lines || chr(10) || 'user:' || chr(10) || 'assistant:'} FROM walk WHERE state = 1) w
  WHERE state IN (0, 3) AND i = (SELECT count(*) FROM f WHERE f.conv_id IS NOT DISTINCT FROM w.conv_id) GROUP BY conv_id),
n AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (odd) AS illegal
  FROM f GROUP BY conv_id)
SELECT done.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
       sha256(best.lines[2:]) AS repaired_sha256
FROM done LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM done.conv_id
"""


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.op12_ranked_search import rank_documents
    return rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


SQL["op12_ranked_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM documents),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
t AS (SELECT count(*) FILTER (len(ws) > 0) AS n, sum(len(ws))::BIGINT AS l FROM d),
tf AS (
  SELECT r, doc_id, len(ws) AS size, term, count(*) AS tf FROM (SELECT r, doc_id, ws, unnest(ws) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, t GROUP BY term, n),
s AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * size * n) // l))))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN w USING (term), t GROUP BY item_id, r, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM s WHERE score > 0) WHERE rank <= 50
"""


def packing_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.llm.op13_best_fit_packing import pack
    return pack(read_table(spark, sf_dir, "documents"), packing_path())


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_language_id": op2_language_id,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_ngram_join": op4_ngram_join,
    "op5_warc": op5_warc,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_url_filters": op7_url_filters,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_ranked_search": op12_ranked_search,
    "op13_best_fit_packing": op13_best_fit_packing,
}
