"""Registered queries of the operators of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_path, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return deco


# --- op5: sharding ----------------------------------------------------------

def _nibble_table() -> str:
    """CRC-32 table of the 16 half-bytes, from its polynomial."""
    out = []
    for x in range(16):
        for _ in range(4):
            x = (x >> 1) ^ 0xEDB88320 if x & 1 else x >> 1
        out.append(f"{x}::UBIGINT")
    return f"[{', '.join(out)}]"


def _op5_sql(shards: int = 40, per_region: int = 8, per_rack: int = 4) -> str:
    """Every node of the tree as a row; each document takes the child with the
    smallest draw at each level."""
    half = "xor({a} >> 4, " + _nibble_table() + "[({a} & 15)::INT + 1])"
    byte = ("list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda p: ((instr('0123456789ABCDEF', p[1]) - 1)"
            " * 16 + instr('0123456789ABCDEF', p[2]) - 1)::UBIGINT)")
    crc = (f"xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, {byte}), lambda a, d: "
           f"{half.format(a=half.format(a='xor(a, d)'))}))::BIGINT")

    def draw(path, weight):
        return f"-ln((('0x' || substr(md5(k || '|' || {path}), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / {weight}"
    regions, racks = shards // per_region, per_region // per_rack
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(doc_id::VARCHAR, '') AS k FROM documents),
 g AS (SELECT doc_id, arg_min(g, w) AS g, min(w) AS w FROM (
   SELECT doc_id, g, {draw("'/g' || g", per_region)} AS w FROM d, range({regions}) AS r(g)) GROUP BY doc_id),
 c AS (SELECT doc_id, arg_min(c, w) AS c FROM (
   SELECT doc_id, c, {draw("'/g' || g || '/k' || c", per_rack)} AS w
   FROM d JOIN g USING (doc_id), range({racks}) AS r(c)) GROUP BY doc_id),
 s AS (SELECT doc_id, arg_min(s, w) AS shard FROM (
   SELECT doc_id, (g * {racks} + c) * {per_rack} + s AS s,
     {draw(f"'/g' || g || '/k' || c || '/s' || ((g * {racks} + c) * {per_rack} + s)", 1)} AS w
   FROM d JOIN g USING (doc_id) JOIN c USING (doc_id), range({per_rack}) AS r(s)) GROUP BY doc_id)
SELECT doc_id, (strlen(text) + 16)::BIGINT AS size, {crc} AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY ('0x' || substr(md5(k || '|slot'), 1, 13))::BIGINT, doc_id) - 1 AS slot,
  (CASE WHEN {draw(f"'/g{regions}'", 1)} < g.w THEN {shards} ELSE shard END)::INTEGER AS grown_shard
FROM d JOIN g USING (doc_id) JOIN s USING (doc_id)"""


@query("op5_hash_tree", _op5_sql())
def op5_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 40 equal shards of 5 regions x 2 racks x 4 shards."""
    from . import shards as S
    root = S.tree(5, 2, 4)
    out = S.assign(table(spark, sf_dir, "documents"), root, S.grow(root, 40))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


# --- op8: quality rules -----------------------------------------------------

@query("op8_crf_quality")
def op8_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and CRF verdict of every document."""
    from . import quality as Q
    docs = table(spark, sf_dir, "documents")
    out = Q.judge(docs, Q.train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", F.round("content_share", 6).alias("content_share"))


# --- op9: personal data -----------------------------------------------------

@query("op9_personal_data")
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    from . import pii as P
    out = P.report(P.find(table(spark, sf_dir, "documents")))
    return out.withColumnRenamed("id", "doc_id")


# --- op2: toxicity ----------------------------------------------------------

@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the rows that are not held out."""
    from . import toxicity as T
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    docs = table(spark, sf_dir, "documents")
    lex = T.learn(docs, table(spark, sf_dir, "labels"), train=fold != 1)
    return T.score(docs, lex).select("doc_id", (fold == 1).alias("held_out"), "score", "predicted", "n_hits")


# --- op6: WARC --------------------------------------------------------------

def _op6_sql() -> str:
    """SHA-1 in base 32: every five hexadecimal digits are four characters."""
    letters = [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v[{i}] >> {s}) & 31)::INT + 1, 1)"
               for i in range(1, 9) for s in (15, 10, 5, 0)]
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
 q AS (SELECT *, list_transform(range(8), lambda i: ('0x' || substr(h, 5 * i + 1, 5))::BIGINT) AS v,
   min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {' || '.join(letters)} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM q"""


@query("op6_warc", _op6_sql())
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    from . import warc
    manifest = warc.write(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.report(warc.read(spark, manifest, payload=False))


# --- op7: mixing ------------------------------------------------------------

def _op7_sql(rounds: int = 25, rate: float = 0.5) -> str:
    """The raking as one CTE for each margin of each round."""
    ctes, last = [], "c0"
    for r in range(rounds):
        for m in ("s", "l", "t"):
            new = f"r{r}{m}"
            w = f"CASE WHEN sum(n * w) OVER (PARTITION BY {m}) > 0 THEN w * g{m} / sum(n * w) OVER (PARTITION BY {m}) ELSE w END"
            if m == "t":
                w = f"least({1 / rate}, {w})"
            ctes.append(f"{new} AS MATERIALIZED (SELECT s, l, t, n, gs, gl, gt, {w} AS w FROM {last})")
            last = new
    goals = ", ".join(
        f"sqrt(n{m}) / (SELECT sum(sqrt(n)) FROM (SELECT sum(n) AS n FROM b GROUP BY {m})) * (SELECT sum(n) FROM b) AS g{m}"
        for m in ("s", "l", "t"))
    return f"""
WITH d AS (SELECT doc_id, source AS s, lang AS l, CASE
    WHEN regexp_matches(coalesce(text, ''), '(?i)licen[sc]e|copyright') THEN 'legal'
    WHEN contains(coalesce(text, ''), '@') THEN 'contact' WHEN contains(coalesce(text, ''), ' | ') THEN 'tabular'
    WHEN length(coalesce(text, '')) > 8000 THEN 'longform' WHEN length(coalesce(text, '')) < 600 THEN 'note'
    ELSE 'prose' END AS t,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n FROM documents),
 b AS (SELECT s, l, t, sum(n)::DOUBLE AS n FROM d GROUP BY s, l, t),
 b2 AS (SELECT *, sum(n) OVER (PARTITION BY s) AS ns, sum(n) OVER (PARTITION BY l) AS nl,
   sum(n) OVER (PARTITION BY t) AS nt FROM b),
 c0 AS MATERIALIZED (SELECT s, l, t, n, {goals}, 1.0::DOUBLE AS w FROM b2),
 {', '.join(ctes)},
 p AS (SELECT s, l, t, w, w * {rate} AS p FROM {last})
SELECT doc_id, d.s AS source, d.l AS lang, d.t AS topic, d.n AS tokens, round(w, 6) AS weight,
  round(p, 6) AS probability,
  (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|mix'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 < p
    AS selected
FROM d JOIN p ON p.s IS NOT DISTINCT FROM d.s AND p.l IS NOT DISTINCT FROM d.l AND p.t IS NOT DISTINCT FROM d.t"""


@query("op7_mixing", _op7_sql())
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling probability of every document after raking to tempered shares."""
    from . import mixing as M
    docs = table(spark, sf_dir, "documents")
    out = M.apply(docs, M.fit(docs))
    return out.select("doc_id", "source", "lang", F.col("_topic").alias("topic"),
                      F.coalesce(F.regexp_count("text", F.lit(M.WORD)), F.lit(0)).cast("long").alias("tokens"),
                      F.round("_weight", 6).alias("weight"), F.round("_probability", 6).alias("probability"),
                      F.col("_selected").alias("selected"))


# --- op1: benchmark decontamination -----------------------------------------

@query("op1_decontaminate")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, with the best alignment of each pair."""
    from . import decontaminate as D
    out = D.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumn("similarity", F.round("similarity", 6))


# --- op3: substring de-duplication ------------------------------------------

@query("op3_substrings")
def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after removing all recurring windows of 35 words."""
    from . import substrings as S
    return S.report(table(spark, sf_dir, "documents"))


# --- op4: n-gram Jaccard join -----------------------------------------------

@query("op4_jaccard")
def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under Jaccard links of 5-word shingles."""
    from . import jaccard as J
    return J.classes(table(spark, sf_dir, "documents"))


# --- op10: line de-duplication ----------------------------------------------

@query("op10_fuzzy_lines")
def op10_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that repeat an earlier line or nearly do."""
    from . import lines as L
    return L.report(table(spark, sf_dir, "documents"))


# --- op11: centroid clustering ----------------------------------------------

def _op11_sql(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256) -> str:
    """Long form: one row per vector and dimension, centroids one CTE a round."""
    ctes = []
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT id, arg_min(c, {{key}}) AS c, min(s) AS distance FROM (
   SELECT e.id, m.c, sum((e.q - m.q) * (e.q - m.q))::BIGINT AS s FROM e JOIN m{r} m ON m.j = e.j GROUP BY e.id, m.c)
   GROUP BY id)""".replace("{key}", f"s * {k} + c"))
        if r < rounds:
            ctes.append(f"""m{r + 1} AS MATERIALIZED (SELECT m.c, m.j, coalesce(n.q, m.q) AS q FROM m{r} m LEFT JOIN (
   SELECT c, j, ((s - ((s % n + n) % n)) // n)::BIGINT AS q
   FROM (SELECT a.c, e.j, sum(e.q)::BIGINT AS s, count(*) AS n FROM e JOIN a{r} a ON a.id = e.id GROUP BY a.c, e.j)) n
   ON n.c = m.c AND n.j = m.j)""")
    return f"""
WITH v AS (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
   WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 e AS MATERIALIZED (SELECT id, j, floor({scale} * x)::BIGINT AS q
   FROM (SELECT id, unnest(v) AS x, unnest(range({dims})) AS j FROM v)),
 f AS (SELECT id, row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c FROM v
   QUALIFY c < {k}),
 m0 AS MATERIALIZED (SELECT f.c, e.j, e.q FROM f JOIN e ON e.id = f.id),
 {', '.join(ctes)},
 t AS (SELECT c, sum(distance) AS s FROM a{rounds} GROUP BY c),
 h AS (SELECT c, sha256(string_agg(q::VARCHAR, ',' ORDER BY j)) AS h FROM m{rounds} GROUP BY c)
SELECT v.vec_id, a.c::INTEGER AS cluster, a.distance::BIGINT AS distance, t.s::BIGINT AS cluster_inertia,
  (SELECT sum(s) FROM t)::BIGINT AS inertia, h.h AS centroid_sha256
FROM v JOIN a{rounds} a ON a.id = v.id JOIN t ON t.c = a.c JOIN h ON h.c = a.c"""


@query("op11_centroids", _op11_sql())
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in 40 clusters after five exact rounds."""
    from . import centroids as K
    return K.cluster(table(spark, sf_dir, "embeddings"))


# --- op12: language ---------------------------------------------------------

@query("op12_language")
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out.
    A text with a letter gets the nearest language; ``rejected`` marks those
    too far from every centroid."""
    from . import langid as L
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    docs = table(spark, sf_dir, "documents")
    out = L.identify(docs, L.learn(docs, fold != 1), reject=False)
    return out.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "distance", "rejected")


# --- op13: source divergence audit ------------------------------------------

def _op13_sql(min_docs: int = 30, top: int = 50, scale: int = 1_000_000_000, smooth: int = 5) -> str:
    """Shares of every group and term, differences summed per pair."""
    p = "1 + ({scale}::HUGEINT * (coalesce({c}, 0) + {smooth})) // (coalesce({n}, 0) + {smooth} * {v})"
    share = p.replace("{scale}", str(scale)).replace("{smooth}", str(smooth))
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
 w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
 kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {min_docs}),
 c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
 g AS (SELECT DISTINCT lang, source FROM d),
 n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
 v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
 p AS MATERIALIZED (SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c,
   ({share.format(c="c.c", n="n.n", v="v.v")})::BIGINT AS p,
   ({share.format(c="kept.total", n="v.n", v="v.v")})::BIGINT AS q
   FROM g JOIN kept ON kept.lang = g.lang JOIN v ON v.lang = g.lang
   LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
   LEFT JOIN n ON n.lang = g.lang AND n.source = g.source),
 s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
   FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
 o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
   FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
   LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
   UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
 r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM o)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= {top}"""


@query("op13_divergence", _op13_sql())
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language and their telling terms."""
    from . import divergence as D
    return D.audit(table(spark, sf_dir, "documents"))
