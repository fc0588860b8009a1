"""Queries that apply the corpus operators to the given tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tankwise.llm import (
    bpe,
    chat,
    decontamination,
    exact_dedup,
    importance,
    jaccard_join,
    language,
    licenses,
    quality,
    repair,
    token_files,
    toxicity,
    warc,
)
from tankwise.llm.common import table
from tankwise.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


JACCARD_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS sh
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
both_ways AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s AS a JOIN s AS b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM both_ways JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
  WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1) AS c USING (doc_id)"""


def license_sql() -> str:
    """The canonical form and both look-ups in SQL, from the same lists."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def lines(column: str) -> str:
        plain = f"replace(lower(coalesce({column}, '')), chr(13), chr(10))"
        plain = f"regexp_replace({plain}, {quoted(licenses.COPYRIGHT_LINE)}, '', 'g')"
        plain = f"regexp_replace({plain}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
        for spelling, same in licenses.SPELLINGS:
            plain = f"replace({plain}, {quoted(spelling)}, {quoted(same)})"
        return plain

    whole = "trim(regexp_replace(f, '[ \\n]+', ' ', 'g'))"
    known = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in licenses.KNOWN)
    return f"""
WITH k AS (
  SELECT form, min(license) AS license
  FROM (SELECT license, {whole} AS form FROM (SELECT license, {lines("text")} AS f FROM (VALUES {known}) AS v(license, text)))
  WHERE form <> '' GROUP BY 1),
d AS (SELECT doc_id, f, {whole} AS form FROM (SELECT doc_id, {lines("text")} AS f FROM documents)),
l AS (SELECT DISTINCT doc_id, license
      FROM (SELECT doc_id, trim(unnest(string_split(f, chr(10)))) AS line FROM d) JOIN k ON line = k.form),
n AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS notices FROM l GROUP BY 1)
SELECT d.doc_id, sha256(d.form) AS canonical_sha256, k.license, coalesce(n.notices, '') AS notices
FROM d LEFT JOIN k ON k.form = d.form LEFT JOIN n ON n.doc_id = d.doc_id"""


CHAT_SQL = """
WITH t AS (
  SELECT *, CAST('0x' || substr(sha256(role || ':' || text), 1, 15) AS BIGINT) AS sub
  FROM (SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)),
r AS (SELECT *, row_number() OVER w AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, sub DESC) AS back,
             count(*) OVER (PARTITION BY conv_id) AS replies
      FROM t WHERE role = 'assistant' WINDOW w AS (PARTITION BY conv_id ORDER BY turn, sub)),
e AS (SELECT conv_id, any_value(replies) AS replies, max(text) FILTER (k = 1) AS said,
             max(turn) FILTER (back = 1) AS last_turn, max(sub) FILTER (back = 1) AS last_sub FROM r GROUP BY 1),
b AS (
  SELECT t.conv_id AS pair_id, turn, sub, role, text,
         coalesce((turn, sub) > (last_turn, last_sub), false) AS gone,
         CASE WHEN role <> 'assistant' THEN text WHEN replies = 1 THEN '' ELSE said END AS alt
  FROM t LEFT JOIN e USING (conv_id)),
f AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn, sub) AS i FROM b),
d AS (SELECT pair_id, min(i) AS spot FROM f WHERE gone OR text <> alt GROUP BY 1),
p AS (SELECT f.*, d.spot IS NULL OR i < d.spot AS early FROM f LEFT JOIN d USING (pair_id)),
s AS (
  SELECT pair_id, CASE WHEN early THEN 'prompt' ELSE 'chosen' END AS part, turn, sub, role, text,
         NOT early AND role = 'assistant' AS train FROM p
  UNION ALL
  SELECT pair_id, 'rejected', turn, sub, role, alt, role = 'assistant' FROM p WHERE NOT early AND NOT gone)
SELECT pair_id, part, turn, sub, role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered, train
FROM s"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * pos_ + 1, 2) AS BIGINT)"
    bits = f"list_transform(range(8), lambda bit_: ({byte} >> bit_) & 1)"
    bits = f"flatten(list_transform(range(strlen({text})), lambda pos_: {bits}))"
    step = "xor(crc_ >> 1, 3988292384 * (xor(crc_, one_) & 1))"
    return f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda crc_, one_: {step}), 4294967295)"


IMPORTANCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
df AS (
  SELECT r, unnest(w) AS f FROM d
  UNION ALL SELECT r, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM d),
bf AS (
  SELECT unnest(w) AS f FROM b
  UNION ALL SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM b),
k AS (SELECT f, CRC % 10000 AS bucket FROM (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf))),
dc AS (SELECT r, bucket, count(*) AS n FROM df JOIN k USING (f) GROUP BY ALL),
sc AS (SELECT bucket, sum(n) AS s FROM dc GROUP BY 1),
tc AS (SELECT bucket, count(*) AS t FROM bf JOIN k USING (f) GROUP BY 1),
z AS (SELECT CAST(coalesce((SELECT sum(s) FROM sc), 0) AS DOUBLE) AS big_s, CAST(coalesce((SELECT sum(t) FROM tc), 0) AS DOUBLE) AS big_t),
g AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (big_s + 10000) / ((s + 1.0::DOUBLE) * (big_t + 10000)))) AS BIGINT) AS gain
  FROM sc LEFT JOIN tc USING (bucket), z),
w AS (SELECT r, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * gain) AS BIGINT) AS total FROM dc JOIN g USING (bucket) GROUP BY 1),
e AS (
  SELECT doc_id, len(d.w) AS n_words, coalesce(n, 0) AS n_features,
         CASE WHEN n > 0 THEN CAST((total - ((total % n) + n) % n) / n AS BIGINT) ELSE 0 END AS weight,
         CAST('0x' || substr(sha256('7:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN w USING (r)),
v AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM e),
x AS (SELECT *, n_words >= 20 AS able, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place FROM v)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN able AND place <= (SELECT 25 * count(*) // 100 FROM v WHERE n_words >= 20) THEN place END AS rank
FROM x""".replace("CRC", crc32_sql("f"))


REPAIR_SQL = r"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
m AS (SELECT *, CRC % 20 AS f FROM o),
dm AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END)) AS again
  FROM m WHERE f <> 0),
q AS (
  SELECT *, row_number() OVER c AS i, lag(role[1]) OVER c AS was,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, again) AS seen,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM dm WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), again)),
p AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                 WHEN bare[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM q),
st AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {'c': 0, 'a': ''} AS s0, {'c': 1000000000, 'a': ''} AS s1,
         {'c': 1000000000, 'a': ''} AS s2, {'c': 1000000000, 'a': ''} AS s3
  FROM (SELECT DISTINCT conv_id FROM p)
  UNION ALL
  SELECT conv_id, i,
         {'c': s0.c + 3, 'a': s0.a || 'D'},
         least({'c': s1.c + 3, 'a': s1.a || 'D'}, {'c': s0.c + ks + cut, 'a': s0.a || 'K'}),
         least({'c': x2.c + 3, 'a': x2.a || 'D'}, {'c': s0.c + ku + cut, 'a': s0.a || 'K'},
               {'c': s1.c + ku + cut, 'a': s1.a || 'K'}, {'c': x3.c + ku + cut, 'a': x3.a || 'K'},
               {'c': s0.c + kr + cut, 'a': s0.a || 'R'}, {'c': s1.c + kr + cut, 'a': s1.a || 'R'},
               {'c': x3.c + kr + cut, 'a': x3.a || 'R'}),
         least({'c': x3.c + 3, 'a': x3.a || 'D'}, {'c': x2.c + ka + cut, 'a': x2.a || 'K'},
               {'c': x2.c + kr + cut, 'a': x2.a || 'R'})
  FROM (
    SELECT *, least(s3, {'c': x2.c + 2, 'a': x2.a || 'I'}) AS x3
    FROM (
      SELECT p.conv_id, p.i, s0, s1, s3,
             least(s2, {'c': s0.c + 2, 'a': s0.a || 'I'}, {'c': s1.c + 2, 'a': s1.a || 'I'}, {'c': s3.c + 2, 'a': s3.a || 'I'}) AS x2,
             CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS cut,
             CASE WHEN fault IN ('', 'truncated') AND role[1] = 's' THEN 0 ELSE 1000000000 END AS ks,
             CASE WHEN fault IN ('', 'truncated') AND role[1] = 'u' THEN 0 ELSE 1000000000 END AS ku,
             CASE WHEN fault IN ('', 'truncated') AND role[1] = 'a' THEN 0 ELSE 1000000000 END AS ka,
             CASE WHEN fault IN ('', 'truncated') THEN 2 ELSE 1000000000 END AS kr
      FROM st JOIN p ON p.conv_id IS NOT DISTINCT FROM st.conv_id AND p.i = st.i + 1))),
en AS (
  SELECT conv_id, least(s0, {'c': x2.c + 2, 'a': x2.a || 'I'}, s3) AS best
  FROM (
    SELECT conv_id, s0, s3,
           least(s2, {'c': s0.c + 2, 'a': s0.a || 'I'}, {'c': s1.c + 2, 'a': s1.a || 'I'}, {'c': s3.c + 2, 'a': s3.a || 'I'}) AS x2
    FROM st JOIN (SELECT conv_id AS id, max(i) AS n FROM p GROUP BY 1) ON conv_id IS NOT DISTINCT FROM id AND i = n)),
ed AS (SELECT conv_id, unnest(string_split(best.a, '')) AS e, unnest(range(len(best.a))) AS pos FROM en),
el AS (
  SELECT *, sum(CASE e WHEN 'I' THEN 0 ELSE 1 END) OVER w AS i, sum(CASE e WHEN 'D' THEN 0 ELSE 1 END) OVER w AS place
  FROM ed WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
lines AS (
  SELECT el.conv_id, el.pos, el.e, el.place, p.role, p.text,
         max(CASE WHEN el.place = 1 AND el.e = 'K' AND p.role[1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY el.conv_id) AS head
  FROM el LEFT JOIN p ON el.conv_id IS NOT DISTINCT FROM p.conv_id AND el.i = p.i
  WHERE el.e <> 'D'),
rp AS (
  SELECT conv_id, string_agg(
    CASE e WHEN 'K' THEN role ELSE CASE (place - head) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END
    || ':' || CASE e WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS body
  FROM lines GROUP BY 1),
ct AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (was IS NOT NULL AND was || role[1] NOT IN ('su', 'ua', 'au')) AS illegal
  FROM p GROUP BY 1)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS a
LEFT JOIN ct ON a.conv_id IS NOT DISTINCT FROM ct.conv_id
LEFT JOIN en ON a.conv_id IS NOT DISTINCT FROM en.conv_id
LEFT JOIN rp ON a.conv_id IS NOT DISTINCT FROM rp.conv_id""".replace("CRC", crc32_sql("k"))


def query(name: str, sql: str | None = None):
    def keep(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return keep


@query(
    "op8_exact_dedup",
    """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents""",
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, folder, "documents"))


@query(
    "op7_decontamination",
    r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dw.n AS n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY 1),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)""",
)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontamination.contamination(found)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op3_bpe")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.fingerprints(table(spark, folder, "documents"), tokenizer_path())


@query("op4_token_files")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    shards = token_files.write(table(spark, folder, "documents"), tokenizer_path(), end_id=2)
    return token_files.checksums(shards)


@query("op10_jaccard_join", JACCARD_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


@query("op9_language")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query("op2_quality")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(
    "op1_warc",
    """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS b FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, CAST(b AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN b >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN b >= 1000 AND page_id < last THEN last END AS refers_to
FROM w""",
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return warc.read(warc.write(table(spark, folder, "pages"))).drop("url", "payload")


@query("op5_chat", CHAT_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    turns = stage(chat.turns(table(spark, folder, "conversations")))
    return chat.preference_segments(stage(chat.repeated_replies(turns)))


@query("op6_licenses", license_sql())
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"), licenses.known_texts(spark))


@query("op11_toxicity")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op12_repair", REPAIR_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return repair.damage_and_repair(table(spark, folder, "conversations"))


@query("op13_importance", IMPORTANCE_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
