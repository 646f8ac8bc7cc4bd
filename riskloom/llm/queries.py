"""One query for each text operator, over whole tables, and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    bpe, chosen_path, clusters, exact_dedup, fingerprints, language, line_dedup, merkle, mixing,
    packing, pii, token_counts, urls)
from riskloom.session import spread

#: The key for the invented persons of the test tables, where the session names none. Never one for real data.
TEST_KEY = "test tables only"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The rules of the URL query: verdict, host with all subdomains, start of the path.
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/"))


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and texts for heavy work per row: a file that is one split is dealt to all cores first."""
    return spread(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")


@query()
def op1_syncmer_fingerprints(spark, sf_dir):
    return fingerprints.document_fingerprints(documents(spark, sf_dir))


@query()
def op2_ngram_jaccard_join(spark, sf_dir):
    return chosen_path.near_duplicates(texts(spark, sf_dir))


@query()
def op3_url_filter(spark, sf_dir):
    model = urls.fit_url_model(urls.labelled_urls(spark))
    return urls.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES, model)


@query()
def op4_token_counts(spark, sf_dir):
    return token_counts.token_counts(texts(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("""
WITH texts AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM texts
WINDOW same AS (PARTITION BY text_sha256)
""")
def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


@query()
def op6_packing(spark, sf_dir):
    return packing.pack_documents(texts(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op7_bpe_round_trip(spark, sf_dir):
    return bpe.round_trips(texts(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op8_pii_pseudonyms(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", F.col("text").alias("before"), "text")
    done = pii.pseudonymise(docs, pii.configured_key(spark, TEST_KEY))
    return done.select("doc_id", "text", (~F.col("before").eqNullSafe(F.col("text"))).alias("changed"))


@query("""
WITH cut AS (
    SELECT doc_id, string_split(text, chr(10)) AS all_lines FROM documents WHERE text IS NOT NULL),
lines AS (
    SELECT doc_id, unnest(all_lines) AS line, generate_subscripts(all_lines, 1) AS pos FROM cut),
windows AS (
    SELECT doc_id, pos, line, lead(line, 1) OVER doc AS line2, lead(line, 2) OVER doc AS line3
    FROM lines WINDOW doc AS (PARTITION BY doc_id ORDER BY pos)),
numbered AS (
    SELECT *, line3 IS NOT NULL AND row_number() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id, pos) > 1 AS later
    FROM windows),
covered AS (
    SELECT doc_id, pos, line, bool_or(later) OVER (PARTITION BY doc_id ORDER BY pos ROWS 2 PRECEDING) AS gone FROM numbered)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
       count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
FROM covered GROUP BY doc_id
UNION ALL
SELECT doc_id, NULL, 0, 0 FROM documents WHERE text IS NULL
""")
def op9_line_dedup(spark, sf_dir):
    return line_dedup.drop_repeated_lines(documents(spark, sf_dir))


@query()
def op10_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = language.fit_language_model(docs)
    found = language.predict_language(texts(spark, sf_dir), model)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def _clusters_sql(rounds: int = clusters.ROUNDS) -> str:
    """All rounds as tables of one query: ``c0`` and ``a0``, then one more of each for every round."""
    assign = """
a{i} AS (
    SELECT r, cluster, d AS distance FROM (
        SELECT r, cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d FROM parts v JOIN c{i} c USING (place) GROUP BY r, cluster)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, cluster) = 1)"""
    update = """,
c{n} AS (
    SELECT c.cluster, c.place, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.x) AS x
    FROM c{i} c LEFT JOIN (
        SELECT cluster, place, sum(x)::BIGINT AS s, count(*) AS n FROM parts JOIN a{i} USING (r) GROUP BY cluster, place) m
    USING (cluster, place)),"""
    steps = "".join(assign.format(i=i) + update.format(i=i, n=i + 1) for i in range(rounds)) + assign.format(i=rounds)
    return f"""
WITH listed AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = {clusters.SIZE}),
cells AS (SELECT r, vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS place FROM listed),
parts AS (
    SELECT r, vec_id, place, floor({clusters.SCALE} * x)::BIGINT AS x FROM cells
    QUALIFY bool_and(x IS NOT NULL AND isfinite(x)) OVER (PARTITION BY r)),
starts AS (
    SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM (SELECT DISTINCT r, vec_id FROM parts)
    QUALIFY cluster < {clusters.CLUSTERS}),
c0 AS (SELECT cluster, place, x FROM parts JOIN starts USING (r)),{steps},
named AS (SELECT cluster, sha256(string_agg(x, ',' ORDER BY place)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN listed USING (r) JOIN named USING (cluster)
"""


@query(_clusters_sql())
def op13_centroid_clustering(spark, sf_dir):
    assigned, centroids = clusters.cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return clusters.with_inertia(assigned, centroids)


def _merkle_sql() -> str:
    """Trees level by level, then every leaf folded along its siblings."""
    def field(column: str) -> str:
        return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR END"

    def digest(n_chars: str) -> str:
        return f"sha256({' || '.join(field(n_chars if c == 'n_chars' else c) for c in merkle.RECORD)})"

    crc = """list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
        lambda x, turn: xor(x >> 1, 3988292384::BIGINT * (x & 1))))"""

    def levels(name: str, leaves: str) -> str:
        return f"""
{name} AS (
    SELECT tree, 0 AS lvl, i, h, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
    UNION ALL
    SELECT tree, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM {name} WHERE n > 1
    GROUP BY tree, lvl, i // 2, n)"""

    def folds(name: str, start: str, nodes: str) -> str:
        return f"""
{name} AS (
    SELECT r, tree, i, 0 AS lvl, h, siblings, (SELECT max(lvl) FROM {nodes} z WHERE z.tree = s.tree) AS height FROM {start} s
    UNION ALL
    SELECT r, f.tree, f.i // 2, f.lvl + 1,
           sha256(CASE WHEN o.h IS NULL THEN f.h WHEN f.i % 2 = 1 THEN o.h || f.h ELSE f.h || o.h END),
           siblings || coalesce(o.h, ''), height
    FROM {name} f LEFT JOIN {nodes} o ON o.tree = f.tree AND o.lvl = f.lvl AND o.i = xor(f.i, 1)
    WHERE f.lvl < height)"""

    return f"""
WITH RECURSIVE records AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce('1' || lang, '') AS tree, {digest('n_chars')} AS h,
           CASE WHEN xor({crc}, 4294967295) % 7 = 0 THEN {digest('(n_chars + 1)')} END AS other, n_chars
    FROM documents),
leaves AS (
    SELECT r, doc_id, tree, h, CASE WHEN n_chars IS NULL THEN h ELSE coalesce(other, h) END AS claimed,
           row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i
    FROM records),{levels('nodes', 'leaves')},
subroots AS (SELECT tree AS name, 'top' AS tree, h, row_number() OVER (ORDER BY tree) - 1 AS i FROM nodes WHERE n = 1),
{levels('tops', 'subroots')},
starts AS (SELECT r, tree, i, claimed AS h, '' AS siblings FROM leaves),{folds('inner_folds', 'starts', 'nodes')},
middles AS (
    SELECT r, s.tree, s.i, f.h, siblings FROM inner_folds f JOIN subroots s ON s.name = f.tree WHERE f.lvl = height),
{folds('outer_folds', 'middles', 'tops')}
SELECT doc_id, l.h AS leaf, s.h AS subroot, t.h AS root, sha256(siblings) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM leaves l JOIN outer_folds f USING (r) JOIN subroots s ON s.name = l.tree JOIN tops t ON t.n = 1
WHERE f.lvl = height
"""


@query(_merkle_sql())
def op12_merkle_manifest(spark, sf_dir):
    return merkle.document_proofs(documents(spark, sf_dir).select(*merkle.RECORD))


@query(f"""
WITH sized AS (
    SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
           md5(concat_ws(':', '{mixing.SEED}', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS place
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source),
weighed AS (SELECT *, [3.0::DOUBLE, 1, 2][rank % 3 + 1] AS weight, 2 * source_size AS most FROM sources),
shared AS (
    SELECT *, ({mixing.SHARE}::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER before, 0))
              / sum(weight) OVER (ORDER BY most / weight DESC, rank DESC) AS each
    FROM weighed WINDOW before AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT each FROM shared QUALIFY row_number() OVER (ORDER BY weight * each >= most, most / weight, rank) = 1),
targets AS (SELECT source, source_size, least(most::DOUBLE, weight * (SELECT each FROM chosen)) AS target, most FROM shared),
placed AS (
    SELECT r, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM sized),
filled AS (SELECT *, least(most, floor(target + 0.5)::BIGINT) AS quota FROM targets)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (greatest(0, least(size, quota - start)) + greatest(0, least(size, quota - source_size - start)))::BIGINT AS taken
FROM sized JOIN placed USING (r) JOIN filled ON filled.source IS NOT DISTINCT FROM sized.source
""")
def op11_source_mix(spark, sf_dir):
    rows, _ = mixing.mix_sources(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "source_size", "target", "taken")
