"""The operators' queries over the documents tables, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import license_scan, mixing
from tessera.llm.collocations import mine_collocations
from tessera.llm.common import held_out
from tessera.llm.decontamination import find_items
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.language_id import predict_language, train_language_id
from tessera.llm.license_scan import scan_licenses
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.mixing import mix
from tessera.llm.ngram_jaccard import jaccard_components
from tessera.llm.packing import pack
from tessera.llm.quality import score_quality, train_quality
from tessera.llm.spelling import spelling_groups
from tessera.llm.substring_dedup import dedup_substrings
from tessera.llm.toxicity import score_toxicity, train_toxicity

QUALITY_CUT = 0.7
TOXIC_CUT = 0.3


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def documents(spark: SparkSession, d: str, *more: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text", *more)


def op1_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return scan_licenses(documents(spark, d)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op2_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup(documents(spark, d))


def op3_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    return mix(documents(spark, d, "source")).select("doc_id", "size", "source_size", "target", "taken")


def op4_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    scored = score_quality(docs, train_quality(docs, table(spark, d, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    scored = score_toxicity(docs, train_toxicity(docs, table(spark, d, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= TOXIC_CUT).cast("int").alias("predicted"),
                         F.size("toxic_hits").cast("long").alias("n_hits"))


def op6_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return find_items(documents(spark, d), table(spark, d, "benchmark")).drop("sketch_containment")


def op7_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d, "lang")
    read = predict_language(docs.drop("lang"), train_language_id(docs))
    return read.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op8_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_components(documents(spark, d))


def op9_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup_substrings(documents(spark, d)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup_lines(documents(spark, d)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return spelling_groups(documents(spark, d))


def op12_collocations(spark: SparkSession, d: str) -> DataFrame:
    return mine_collocations(documents(spark, d, "lang"))


def op13_packing(spark: SparkSession, d: str) -> DataFrame:
    return pack(documents(spark, d)).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                            "doc_tokens", "sequence_id", "offset")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_license_scan, op2_exact_dedup, op3_mix_sources, op4_quality, op5_toxicity, op6_decontamination,
        op7_language_id, op8_ngram_jaccard, op9_substring_dedup, op10_line_dedup, op11_spelling_variants,
        op12_collocations, op13_packing)}


# --------------------------------------------------------------- oracle SQL

BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _values(rows) -> str:
    quote = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(quote(v) for v in r) + ")" for r in rows)


def license_sql() -> str:
    """Every block against every template, without filters."""
    k, word = license_scan.STRIDE, license_scan.WORD_RUN
    return f"""
WITH t(name, body) AS (VALUES {_values(license_scan.TEMPLATES.items())}),
p(body, name) AS (VALUES {_values(license_scan.PHRASES.items())}),
d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all({LOWER}, '{word}') AS w FROM documents),
blocks AS (SELECT rid, list_distinct(list_slice(w, b * {k} + 1, (b + 2) * {k})) AS bag
           FROM (SELECT rid, w, unnest(range(0, len(w) // {k} + 1)) AS b FROM d)),
matches AS (SELECT rid, name, len(list_intersect(bag, list_distinct(string_split(body, ' '))))
              / len(list_distinct(string_split(body, ' ')))::DOUBLE AS share FROM blocks, t),
best AS (SELECT rid, list(DISTINCT name) AS names, max(share) AS share FROM matches
         WHERE share >= {license_scan.THRESHOLD} - 1e-9 GROUP BY rid),
places AS (SELECT rid, name, a FROM (SELECT rid, w, unnest(range(0, len(w))) AS a FROM d), p
           WHERE list_slice(w, a + 1, a + len(string_split(body, ' '))) = string_split(body, ' ')),
base AS (SELECT rid, count(*) AS n, min(a) AS lo, max(a) AS hi, list(DISTINCT name) AS names FROM places GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
  array_to_string(list_sort(coalesce(base.names, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.names, []), coalesce(best.names, [])))), ',') AS labels,
  CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(best.share, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN best USING (rid)
"""


EXACT_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{BLANK}+', ' ', 'g') AS t FROM documents),
n AS (SELECT doc_id, t, row_number() OVER (PARTITION BY t ORDER BY doc_id) AS nth,
        min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, nth = 1 AS kept, sha256(t) AS text_sha256 FROM n
"""


def mix_sql(source: str = "documents") -> str:
    cycle = len(mixing.WEIGHTS)
    weight = " ".join(f"WHEN {i} THEN {float(w)}::DOUBLE" for i, w in enumerate(mixing.WEIGHTS))
    return rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{NOT_BLANK}'))::BIGINT AS size,
    greatest(0.1::DOUBLE, 1.0::DOUBLE - 4.0::DOUBLE * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{mixing.SYMBOLS}', '')))
      / greatest(length(coalesce(text, '')), 1)) AS q,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u FROM {source}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {cycle} {weight} END AS w,
    {mixing.MAX_EPOCHS} * source_size AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER ()::DOUBLE * {mixing.SHARE_NUM} / {mixing.SHARE_DEN} - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap::DOUBLE, coalesce((SELECT max(level) FROM l WHERE cap >= level * w) * w, cap::DOUBLE)) AS target FROM l),
e AS (SELECT *, least({mixing.MAX_EPOCHS}, floor(target / greatest(source_size, 1)))::BIGINT AS epochs FROM t),
r AS (SELECT d.*, source_size, target, epochs, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / q, doc_id NULLS LAST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size,
    floor(target)::BIGINT - epochs * source_size - ahead)))::BIGINT AS taken FROM r
"""


DECONTAMINATION_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array({lower}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array({lower}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
      WHERE item_id IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + 4), ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM d)),
ss AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, k, k + 4), ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS k FROM i)),
n AS (SELECT item_id, count(*) AS n_shingles FROM ss GROUP BY item_id),
f AS (SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN ss USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles::BIGINT AS n_shingles, n_found::BIGINT AS n_found,
  n_found / n_shingles::DOUBLE AS containment
FROM f JOIN n USING (item_id) WHERE n_found >= 0.75 * n_shingles
""".replace("{lower}", LOWER)


JACCARD_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{NOT_BLANK}') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + 4), ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id,
  count(*) OVER (PARTITION BY CASE WHEN n.n IS NULL THEN '' ELSE sets.k END)::BIGINT AS class_size
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS c FROM r GROUP BY a) m USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(s, chr(10) ORDER BY s) AS k FROM sh GROUP BY doc_id) sets USING (doc_id)
"""

SUBSTRING_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{NOT_BLANK}') AS w FROM documents),
win AS (SELECT doc_id, k, md5(array_to_string(list_slice(w, k, k + 34), ' ')) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS k FROM d)),
rep AS (SELECT doc_id, k FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS p FROM rep),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
         FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

LINES_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
own AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
g AS (SELECT k.*, owner IS NOT NULL AND owner <> doc_id AS gone FROM k LEFT JOIN own USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM g GROUP BY doc_id
"""


#: crc32 over the bytes, by a table that eight shifts make; near words meet in
#: what is left of them without one code point
SPELLING_SQL = f"""
WITH RECURSIVE table_(c, i, k) AS (SELECT range, range, 0 FROM range(256) UNION ALL
  SELECT CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i, k + 1 FROM table_ WHERE k < 8),
t AS (SELECT list(c ORDER BY i) AS t FROM table_ WHERE k = 8),
r AS (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
g AS (SELECT run, hex(encode(coalesce(doc_id::VARCHAR, 'null') || ':' || run)) AS x, count(*) AS n
      FROM r WHERE length(run) >= 7 GROUP BY ALL),
h AS (SELECT run, n, xor(list_reduce(list_transform(range(0, len(x), 2), lambda i: ('0x' || substr(x, i + 1, 2))::BIGINT),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM g, t),
v AS MATERIALIZED (SELECT w AS word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 31 = 0
        THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS w FROM h)
      WHERE length(w) >= 7 GROUP BY w HAVING sum(n) >= 2),
p AS (SELECT word, unnest(range(0, length(word))) AS i FROM v),
q AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS less FROM p),
e AS (SELECT a.word AS a, b.word AS b FROM q a JOIN q b ON a.less = b.less AND a.i = b.i WHERE a.word <> b.word
      UNION SELECT q.word, v.word FROM q JOIN v ON v.word = q.less UNION SELECT v.word, q.word FROM q JOIN v ON v.word = q.less),
f AS (SELECT a AS word, count(*) AS n_near, min(struct_pack(n := -n, w := word)) AS m FROM e JOIN v ON v.word = e.b GROUP BY a),
o AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -m.n >= 10 * v.n THEN m.w END AS form,
        CASE WHEN -m.n >= 10 * v.n THEN -m.n END AS form_n FROM v LEFT JOIN f USING (word)),
s(word, tip, k) AS (SELECT word, word, 0 FROM o UNION ALL SELECT s.word, o.form, k + 1 FROM s JOIN o ON o.word = s.tip WHERE o.form IS NOT NULL)
SELECT word, form, (SELECT arg_max(tip, k) FROM s WHERE s.word = o.word) AS root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM o
"""


COLLOCATION_SQL = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM (
        SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 5)) AS k)))
      GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
s AS (SELECT lang, c.phrase, c.a, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a + r.a) AS score, cut
      FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
      JOIN f l USING (lang) JOIN f r USING (lang)
      WHERE l.phrase = array_to_string(c.w[1:cut], ' ') AND r.phrase = array_to_string(c.w[cut + 1:], ' ')),
m AS (SELECT lang, phrase, a, l, r, score FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, array_to_string(list_slice(w, i, i + z - 1), ' ') AS phrase, max(a) AS most
      FROM (SELECT lang, w, a, z, unnest(range(1, k - z + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS z FROM c)) GROUP BY ALL),
o AS (SELECT m.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM m LEFT JOIN i USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM o JOIN n USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express at the size of the check."""
    return {"op1_license_scan": license_sql(), "op2_exact_dedup": EXACT_SQL, "op3_mix_sources": mix_sql(),
            "op6_decontamination": DECONTAMINATION_SQL, "op8_ngram_jaccard": JACCARD_SQL,
            "op9_substring_dedup": SUBSTRING_SQL, "op10_line_dedup": LINES_SQL,
            "op11_spelling_variants": SPELLING_SQL, "op12_collocations": COLLOCATION_SQL}
