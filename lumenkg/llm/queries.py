"""Registered queries of the training-data operators and their SQL."""
from __future__ import annotations

from pyspark.sql import functions as F

from . import collocations, decontam, lines, mixing, passages, pii, quality, secretscan, shallot, simhash, tokens, topk, toxicity
from .common import read_table


def op1_pii(spark, sf_dir):
    return pii.pii_spans(read_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark, sf_dir):
    return passages.substring_dedup(read_table(spark, sf_dir, "documents"), window=50).drop("kept")


def op3_quality(spark, sf_dir):
    """Grades of every document; the model is fitted on at most 20,000 labelled ones.  Probabilities are
    rounded to six places, as sums of weights depend on their order in the last ones."""
    docs = read_table(spark, sf_dir, "documents")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"), sample=20_000)
    return quality.graded(docs, model).select(
        "doc_id", F.round("expected_grade", 6).alias("expected_grade"), F.round("p_good", 6).alias("p_good"), (F.col("p_good") >= 0.5).alias("keep"))


def op4_secrets(spark, sf_dir):
    return secretscan.secret_spans(read_table(spark, sf_dir, "documents"))


def op5_topk(spark, sf_dir):
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20, scale=64)


def op6_mixing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs).withColumn("source", F.coalesce("source", F.lit("")))


def op7_token_counts(spark, sf_dir):
    return tokens.token_digest(tokens.section_tokens(read_table(spark, sf_dir, "documents"), rule="majority"))


def op8_decontamination(spark, sf_dir):
    return decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op10_line_dedup(spark, sf_dir):
    return lines.line_dedup(read_table(spark, sf_dir, "documents"), max_ratio=0.02, min_pages=5)


def op11_collocations(spark, sf_dir):
    return collocations.collocations(read_table(spark, sf_dir, "documents"), least=30, longest=4, part=80, top=2000)


def op12_clusters(spark, sf_dir):
    return shallot.clusters(read_table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64, seed=1)


def op13_toxicity(spark, sf_dir):
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), sample=20_000, size=4096)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality": op3_quality,
    "op4_secrets": op4_secrets,
    "op5_topk": op5_topk,
    "op6_mixing": op6_mixing,
    "op7_token_counts": op7_token_counts,
    "op8_decontamination": op8_decontamination,
    "op9_simhash": op9_simhash,
    "op10_line_dedup": op10_line_dedup,
    "op11_collocations": op11_collocations,
    "op12_clusters": op12_clusters,
    "op13_toxicity": op13_toxicity,
}

OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
least AS (SELECT h, min(doc_id) AS m FROM win GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN least USING (h) WHERE m < doc_id),
k AS (SELECT x.doc_id, count(gone.p) AS n, coalesce(string_agg(CASE WHEN gone.p IS NULL THEN x.word END, ' ' ORDER BY x.p), '') AS kept
      FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d) x LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.p = x.p GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""

OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM p) WHERE r <= 20
"""

OP6_SQL = """
WITH RECURSIVE w AS (SELECT coalesce(source, '') AS source, CAST(ceil(sqrt(count(*))) AS BIGINT) AS weight FROM documents GROUP BY 1),
t AS (SELECT count(*) AS n, CAST(sum(weight) AS BIGINT) AS total FROM w),
b AS (SELECT source, (1000 - n) * weight // total AS base, (1000 - n) * weight % total AS rest, 1000 - n AS room FROM w, t),
sh AS (SELECT source, CAST(1 + base + CASE WHEN row_number() OVER (ORDER BY rest DESC, source) <= room - (SELECT sum(base) FROM b) THEN 1 ELSE 0 END AS BIGINT) AS a FROM b),
arr AS (SELECT list(a ORDER BY source) AS a, list(source ORDER BY source) AS names FROM sh),
sim(t, nx, pick, turn) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(a, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM arr
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(nx) + 1), lambda i: CAST(nx[i] + CASE WHEN i = p THEN 1 ELSE 0 END AS BIGINT)), p, nx[p]
  FROM (SELECT t, nx, CAST((list_sort(list_filter(list_transform(range(1, len(a) + 1),
          lambda i: {'due': ((nx[i] + 1) * 1000 + a[i] - 1) // a[i], 'free': nx[i] * 1000 // a[i], 'i': i}), lambda c: c.free <= t + 1))[1]).i AS BIGINT) AS p
        FROM sim, arr WHERE t + 1 < 1000)),
plan AS (SELECT names[pick] AS source, a[pick] AS a, turn, t AS place0 FROM sim, arr WHERE t >= 0),
num AS (SELECT doc_id, coalesce(source, '') AS source, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS n FROM documents)
SELECT num.doc_id, num.source, n // 16 AS mix_block, CAST(n % 16 AS INTEGER) AS mix_place, (n // 16 // plan.a) * 1000 + place0 AS mix_slot,
  (n // 16) * 1000 // plan.a AS mix_release, ((n // 16 + 1) * 1000 + plan.a - 1) // plan.a AS mix_due
FROM num JOIN plan ON plan.source = num.source AND plan.turn = (n // 16) % plan.a
"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
occ AS (SELECT DISTINCT doc_id, item_id, i, iw.k FROM dw JOIN iw ON dw.win = iw.win AND dw.k = iw.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM occ)) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(it.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(it.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""

OP10_SQL = """
WITH l AS (SELECT doc_id, coalesce(source, chr(0) || 'null') AS host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
m AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS mark FROM l),
p AS (SELECT coalesce(source, chr(0) || 'null') AS host, count(*) AS pages FROM documents GROUP BY 1),
bp AS (SELECT host, mark FROM (SELECT host, mark, count(DISTINCT doc_id) AS n FROM m WHERE mark <> '' GROUP BY 1, 2) JOIN p USING (host) WHERE n >= 5 AND n > 0.02 * pages),
k AS (SELECT m.doc_id, count(*) AS n_lines, count(bp.mark) AS n_dropped, coalesce(string_agg(CASE WHEN bp.mark IS NULL THEN line END, chr(10) ORDER BY i), '') AS kept
      FROM m LEFT JOIN bp ON m.host = bp.host AND m.mark = bp.mark GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN k USING (doc_id)
"""

OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
t AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT lang, phrase, a, k, w, unnest(range(1, k)) AS j FROM c),
s AS (SELECT cut.lang, cut.phrase, cut.a, j, x.f AS l, y.f AS r, CAST(2000000 * CAST(cut.a AS HUGEINT) // (x.f + y.f) AS BIGINT) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1 : j], ' ') JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[j + 1 : cut.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
sub AS (SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer
        FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY 1, 2),
kept AS (SELECT b.* FROM b LEFT JOIN sub ON sub.lang = b.lang AND sub.phrase = b.phrase WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN t USING (lang) WHERE rank <= 2000
"""


def _op12_sql(k: int, rounds: int) -> str:
    """The rounds one after another; distances and sums in whole numbers."""
    out = [f"""WITH x AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, vec_id, v) - 1 AS c, v FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, vec_id, v FROM x WHERE vec_id IS NOT NULL ORDER BY 1, 2, 3 LIMIT {k}))"""]
    for i in range(rounds + 1):
        out.append(f"""a{i} AS MATERIALIZED (SELECT row, vec_id, v, CAST(best % {k} AS BIGINT) AS c, CAST(best // {k} AS BIGINT) AS d FROM (
  SELECT row, any_value(x.vec_id) AS vec_id, any_value(x.v) AS v, min(CAST(list_sum(list_transform(list_zip(x.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS HUGEINT) * {k} + c) AS best FROM x, c{i} GROUP BY 1))""")
        if i < rounds:
            out.append(f"""c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
  SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM (SELECT c, j, sum(e) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS e, generate_subscripts(v, 1) AS j FROM a{i}) GROUP BY 1, 2) GROUP BY 1) m ON m.c = c{i}.c)""")
    last = f"a{rounds}"
    return ",\n".join(out) + f"""
SELECT vec_id, CAST({last}.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY {last}.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256 FROM {last} JOIN c{rounds} ON c{rounds}.c = {last}.c
"""


OP12_SQL = _op12_sql(16, 3)

ORACLES = {"op2_substring_dedup": OP2_SQL, "op5_topk": OP5_SQL, "op6_mixing": OP6_SQL, "op8_decontamination": OP8_SQL, "op10_line_dedup": OP10_SQL,
           "op11_collocations": OP11_SQL, "op12_clusters": OP12_SQL}
