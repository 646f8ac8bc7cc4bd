"""Text."""

import re

from pyspark.sql import functions as F

from riskloom.checks import query, table
from riskloom.functions.text import HAN, tokenize, user_tokenizer
from riskloom.operators.segments import with_best_path
from riskloom.operators.terms import (
    VECTOR_SIZE, document_vectors, fit_word_vectors, term_frequencies, term_indicators, top_terms)
from riskloom.plans.stacking import term_stacking
from riskloom.session import spread

# Runs between ASCII characters that are no letter or digit, and CJK punctuation.
SPLIT = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F，。、；：！？（）【】《》“”‘’·…—　"
RUNS_SQL = f"regexp_extract_all(text, '[{HAN}]+|[^{SPLIT}{HAN}]+')"
LATIN, IDEOGRAPHS = "etaoinsrhl", "中文企业销售机电设备"


def documents(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


@query(f"SELECT doc_id, len({RUNS_SQL}) AS n_terms, md5(array_to_string({RUNS_SQL}, ' ')) AS terms_md5 FROM documents")
def tokenize_terms(spark, sf_dir):
    """All terms of every text, in order; the list is compared by its digest."""
    terms = documents(spark, sf_dir).select("doc_id", tokenize(F.col("text")).alias("t"))
    return terms.select("doc_id", F.size("t").cast("bigint").alias("n_terms"),
                        F.md5(F.array_join("t", " ").cast("binary")).alias("terms_md5"))


@query(f"""
SELECT conv_id, turn, len(t) AS n_terms, md5(array_to_string(t, ' ')) AS terms_md5 FROM (
  SELECT conv_id, turn, flatten(list_transform({RUNS_SQL}, lambda r:
    CASE WHEN regexp_matches(r, '^[{HAN}]') AND length(r) > 2
         THEN list_transform(range(1, length(r)), lambda i: substr(r, i, 2)) ELSE [r] END)) AS t
  FROM (SELECT conv_id, turn, translate(text, '{LATIN}', '{IDEOGRAPHS}') AS text FROM conversations))
""")
def tokenize_ideographs(spark, sf_dir):
    """Character pairs of unsegmented runs, on texts with letters turned into ideographs."""
    texts = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.translate("text", LATIN, IDEOGRAPHS).alias("text"))
    terms = texts.select("conv_id", "turn", tokenize(F.col("text")).alias("t"))
    return terms.select("conv_id", "turn", F.size("t").cast("bigint").alias("n_terms"),
                        F.md5(F.array_join("t", " ").cast("binary")).alias("terms_md5"))


@query("""
SELECT conv_id, turn, len(t) AS n_terms, md5(array_to_string(t, ' ')) AS terms_md5
FROM (SELECT conv_id, turn, regexp_extract_all(text, '[A-Za-z]+') AS t FROM conversations)
""")
def tokenize_with_user_function(spark, sf_dir):
    """Terms from a Python function on one text, applied in Arrow batches."""
    letters = re.compile("[A-Za-z]+")
    terms = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", user_tokenizer(letters.findall)(F.col("text")).alias("t"))
    return terms.select("conv_id", "turn", F.size("t").cast("bigint").alias("n_terms"),
                        F.md5(F.array_join("t", " ").cast("binary")).alias("terms_md5"))


@query(f"""
SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df
FROM (SELECT doc_id, unnest({RUNS_SQL}) AS term FROM documents) GROUP BY 1
""")
def term_frequency(spark, sf_dir):
    return term_frequencies(documents(spark, sf_dir), F.col("text"))


@query(f"""
SELECT term, count(*) AS tf FROM (SELECT unnest({RUNS_SQL}) AS term FROM documents) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50
""")
def term_frequency_topk(spark, sf_dir):
    return top_terms(documents(spark, sf_dir), F.col("text"), 50)


@query(f"""
WITH t AS (SELECT doc_id, {RUNS_SQL} AS terms FROM documents),
     v AS (SELECT list(term ORDER BY tf DESC, term) AS terms FROM (
       SELECT term, count(*) AS tf FROM (SELECT unnest(terms) AS term FROM t) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20))
SELECT doc_id, {", ".join(f"CASE WHEN list_contains(t.terms, v.terms[{i + 1}]) THEN 1 ELSE 0 END AS has_{i}" for i in range(20))}
FROM t, v
""", name="term_indicators")
def term_indicator_columns(spark, sf_dir):
    """0/1 columns of the most frequent terms."""
    texts = documents(spark, sf_dir)
    vocabulary = [row["term"] for row in top_terms(texts, F.col("text"), 20).collect()]  # 20 rows by design
    return term_indicators(texts, ["doc_id"], F.col("text"), vocabulary)


@query()
def w2v_text_features(spark, sf_dir):
    """Word vectors trained on all texts, ten mean-vector columns per text."""
    texts = documents(spark, sf_dir)
    every = texts.select("text").unionByName(table(spark, sf_dir, "benchmark").select("text")).unionByName(
        table(spark, sf_dir, "conversations").select("text"))
    model = fit_word_vectors(every, F.col("text"))
    names = [f"text_array_{i}_fea" for i in range(VECTOR_SIZE)]
    return document_vectors(texts, model, F.col("text"), names).drop("text")


@query(f"""
WITH t AS (SELECT conv_id, turn, coalesce({RUNS_SQL}, []) AS terms FROM conversations),
     often AS (SELECT term FROM (SELECT unnest(terms) AS term FROM t) GROUP BY 1 HAVING count(*) > 1),
     known AS (SELECT DISTINCT conv_id, turn FROM (SELECT conv_id, turn, unnest(terms) AS term FROM t) JOIN often USING (term))
SELECT conv_id, turn, CAST(known.conv_id IS NULL AS INTEGER) AS is_zero FROM t LEFT JOIN known USING (conv_id, turn)
""")
def w2v_zero_vectors(spark, sf_dir):
    """A text's vector is zero exactly when none of its terms occurs twice in the corpus."""
    texts = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    names = [f"v{i}" for i in range(VECTOR_SIZE)]
    vectors = document_vectors(texts, fit_word_vectors(texts, F.col("text")), F.col("text"), names)
    largest = F.greatest(*[F.abs(name) for name in names])
    return vectors.select("conv_id", "turn", (largest == 0).cast("int").alias("is_zero"))


@query(f"""
WITH t AS (SELECT conv_id, turn, {RUNS_SQL} AS terms FROM conversations),
     tenth AS (SELECT term FROM (SELECT unnest(terms) AS term FROM t) GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1 OFFSET 9)
SELECT CASE WHEN turn % 3 = 0 THEN 'test' ELSE 'train' END AS split, conv_id || '-' || turn AS qymc,
       CAST(list_contains(t.terms, tenth.term) AS INTEGER) AS predicted
FROM t, tenth
""")
def term_stacking_rule(spark, sf_dir):
    """Each text once, train rows by a model that did not see them; the label is whether the text has the tenth of ten terms."""
    texts = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("jyfw"))
    tenth = top_terms(texts, F.col("jyfw"), 10).collect()[9]["term"]  # 10 rows by design
    rows = texts.select(
        F.when(F.col("turn") % 3 == 0, "test").otherwise("train").alias("split"),
        F.concat_ws("-", "conv_id", "turn").alias("qymc"), "jyfw", F.lit(None).cast("string").alias("jgdzzs"),
        F.array_contains(tokenize(F.col("jyfw")), tenth).cast("double").alias("label"))
    scored = term_stacking(rows, "label", "score", terms=10)
    return scored.select("split", "qymc", (F.col("score") > 0.5).cast("int").alias("predicted"))


# A fixed lexicon with costs, in which words overlap; a letter that is no word costs 10.
COSTS = {"economy": 5, "eco": 2, "nomy": 2, "promo": 4, "pro": 2, "mo": 1, "standard": 5, "stand": 2, "medium": 4, "small": 3, "large": 3,
         "cold": 3, "hot": 3, "col": 1, "dw": 3, "widget": 4, "wid": 2, "get": 1, "bolt": 3, "old": 2, "idg": 1, "gear": 3, "ear": 1}
LONGEST_COST = max(map(len, COSTS))


@query(f"""
WITH RECURSIVE texts AS (
    SELECT DISTINCT lower(p_type) || replace(lower(p_name), ' ', '') AS text FROM part),
walk AS (
    SELECT text, 0 AS pos, [0::BIGINT] AS costs FROM texts
    UNION ALL
    SELECT text, pos + 1, list_append(costs, list_min(list_transform(range(1, least({LONGEST_COST}, pos + 1) + 1), lambda n:
        costs[pos + 2 - n] + coalesce(MAP {{{', '.join(f"'{w}': {c}" for w, c in COSTS.items())}}}[substr(text, pos + 2 - n, n)],
                                      CASE WHEN n = 1 THEN 10 END))))
    FROM walk WHERE pos < length(text))
SELECT p_partkey, text AS joined, CAST(costs[-1] AS DOUBLE) AS cost
FROM part JOIN walk ON text = lower(p_type) || replace(lower(p_name), ' ', '') AND pos = length(text)
""")
def segment_best_path(spark, sf_dir):
    """Unspaced names cut by a lexicon: the cheapest path, and its words put together again."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(
        F.lower("p_type"), F.replace(F.lower("p_name"), F.lit(" "), F.lit(""))).alias("text"))
    return with_best_path(rows, "text", COSTS, unknown=10).select("p_partkey", F.array_join("words", "").alias("joined"), "cost")
