"""The registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import (alignment, bpe, decontaminate, jaccard, langid, license_scan, mixing, pii, quality_rank, quality_rules, spelling,
                         token_output, topk)
from lectern.llm.common import documents, read_table

# Word count of a text in DuckDB, the words of the contract.
_SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rule and adaptive fences for every document."""
    j = quality_rules.judge(documents(spark, sf_dir))
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "kept_lang", "kept_all")


def sql_op1() -> str:
    Q = quality_rules
    ms = {"symbols": "n_symbols * 1000", "word_length": "word_chars * 100",
          "dup_lines": "n_dup_lines * 1000", "repeats": "n_repeat_words * 1000"}
    melted = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {e} // n_words AS v FROM b "
                                f"WHERE NOT base_failed AND n_words > 0" for m, e in ms.items())
    least = "CASE measure " + " ".join(f"WHEN '{m}' THEN {d}" for m, (_, d) in Q.MEASURES.items()) + " END"

    def quart(keys: str) -> str:
        by = f"{keys}, measure" if keys else "measure"
        return f"""SELECT {by}, max(docs) AS docs, min(bucket) FILTER (upto * 4 >= docs) AS q1,
                          min(bucket) FILTER (upto * 4 >= docs * 3) AS q3
                   FROM (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY bucket) AS upto,
                                sum(n) OVER (PARTITION BY {by}) AS docs
                         FROM (SELECT {by}, bucket, sum(n) AS n FROM sk GROUP BY {by}, bucket)) GROUP BY {by}"""
    fenced = ", ".join(f"{x}_q1 - greatest(({x}_q3 - {x}_q1) * {Q.SPREAD}, {least}) AS {x}_lo, "
                       f"{x}_q3 + greatest(({x}_q3 - {x}_q1) * {Q.SPREAD}, {least}) AS {x}_hi" for x in "ago")
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text, {_SQL_WORDS} AS w,
                  [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
           FROM documents),
p AS (SELECT rid, unnest(range(1, len(w) - {Q.WINDOW - 2})) AS i FROM t WHERE len(w) > {Q.WINDOW}),
k AS (SELECT p.rid, i, array_to_string(list_slice(w, i, i + {Q.WINDOW - 1}), ' ') AS key FROM p JOIN t USING (rid)),
d AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, key) AS c FROM k) WHERE c > 1),
r AS (SELECT rid, sum(step)::BIGINT AS n FROM (
        SELECT rid, least({Q.WINDOW}, coalesce(i - lag(i) OVER (PARTITION BY rid ORDER BY i), {Q.WINDOW})) AS step FROM d)
      GROUP BY rid),
s AS (SELECT rid, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '{Q.SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
      FROM t LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PCT} * n_words AS base_failed FROM s),
m AS ({melted}),
x AS (SELECT *, (2 ** greatest(length(bin(v)) - {Q.SKETCH_BITS}, 0))::BIGINT AS step FROM m),
sk AS (SELECT lang, source, measure, v // step * step AS bucket, count(*) AS n FROM x GROUP BY ALL),
f AS (SELECT a.lang, a.source, a.measure, {', '.join(f'{x}.{c} AS {x}_{c}' for x in 'ago' for c in ('q1', 'q3'))}
      FROM ({quart('lang, source')}) a JOIN ({quart('lang')}) g ON a.lang IS NOT DISTINCT FROM g.lang AND a.measure = g.measure
      JOIN ({quart('')}) o ON a.measure = o.measure),
v AS (SELECT lang, source, measure, {fenced} FROM f),
e AS (SELECT b.rid, bool_or(q < a_lo OR q > a_hi) AS outside, bool_or(q < g_lo OR q > g_hi) AS outside_lang,
             bool_or(q < o_lo OR q > o_hi) AS outside_all
      FROM (SELECT rid, lang, source, unnest([{', '.join(f"'{m}'" for m in ms)}]) AS measure,
                   unnest([{', '.join(f'{x} // n_words' for x in ms.values())}]) AS q
            FROM b WHERE NOT base_failed AND n_words > 0) b
      JOIN v ON b.lang IS NOT DISTINCT FROM v.lang AND b.source IS NOT DISTINCT FROM v.source AND b.measure = v.measure
      GROUP BY b.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(outside, false) AS kept,
       NOT base_failed AND NOT coalesce(outside_lang, false) AS kept_lang,
       NOT base_failed AND NOT coalesce(outside_all, false) AS kept_all
FROM b LEFT JOIN e USING (rid)"""


def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as ORC in id order and read back."""
    return token_output.store_and_check(documents(spark, sf_dir))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed; words taken from each."""
    m = mixing.plan_mix(documents(spark, sf_dir))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                    "copies", "rate")


def sql_op3() -> str:
    arms = " ".join(f"WHEN {i} THEN {float(w)}" for i, w in enumerate(mixing.WEIGHTS))
    return f"""
WITH d AS (SELECT doc_id, source, len({_SQL_WORDS})::BIGINT AS size FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} {arms} END::DOUBLE AS weight,
             ({mixing.MAX_REPEAT} * source_size)::DOUBLE AS cap FROM p),
l AS (SELECT *, (sum(source_size) OVER ())::DOUBLE AS total,
             coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
             sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
f AS (SELECT (total - used) / rest AS level FROM l WHERE cap / weight >= (total - used) / rest
      ORDER BY cap / weight, level LIMIT 1),
t AS (SELECT source, source_size, least(cap, (SELECT level FROM f) * weight) AS target FROM w),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t),
c AS (SELECT doc_id, size, source_size, target, rate,
             (floor(rate) + CASE WHEN ('0x' || substr(md5('{mixing.SEED}|' || coalesce(doc_id::VARCHAR, chr(0))), 1, 8))::BIGINT / 4294967296.0
                                 < rate - floor(rate) THEN 1 ELSE 0 END)::INTEGER AS copies
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies, rate FROM c"""


def op4_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bradley-Terry quality score of every document."""
    return quality_rank.rank(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, family first."""
    docs = documents(spark, sf_dir)
    return langid.identify(docs, langid.train(docs))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document, its own or its nearest directory's.

    The table has no paths: a document lies at ``source/thousand/hundred/doc_id.txt``,
    those divisible by 100 one directory higher and by 1,000 two.  A document
    with a license of its own, in whatever line, speaks for its directory.
    """
    d = documents(spark, sf_dir)
    k = F.col("doc_id")
    folder = F.concat_ws("/", F.coalesce("source", F.lit("none")),
                         F.when(k % 1000 != 0, F.floor(k / 1000)), F.when(k % 100 != 0, F.floor(k / 100)))
    d = d.select("doc_id", "text", F.concat_ws("/", folder, F.concat(k, F.lit(".txt"))).alias("path"))
    s = license_scan.scan(d, gives=F.col("own").isNotNull())
    return s.select(F.col("id").alias("doc_id"), "path", "own", F.round("cosine", 6).alias("cosine"), "license", "license_dir",
                    F.col("distance").cast("long").alias("distance"))


def op7_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document; counts and digest of the base rules."""
    f = pii.find(documents(spark, sf_dir))
    kinds = F.transform("base", lambda s: s["kind"])
    count = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return f.select("doc_id", *count, F.sha2(pii.tagged("base"), 256).alias("base_sha256"), pii.tagged("spans").alias("spans"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best candidates of every hundredth vector."""
    return topk.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def sql_op8() -> str:
    return f"""
WITH e AS (SELECT row_number() OVER () AS rid, vec_id, [floor({topk.SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_sum([x[1] * x[2] FOR x IN list_zip(q.v, c.v)])::BIGINT AS score
      FROM e q JOIN e c ON q.rid <> c.rid WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded through the built sentencepiece model and decoded."""
    return bpe.digests(documents(spark, sf_dir))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document: three-word n-grams, similarity 0.9."""
    return jaccard.near_duplicates(documents(spark, sf_dir), n=3, num=90, den=100)


def sql_op10() -> str:
    w = _SQL_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {w} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE [array_to_string(list_slice(w, i, i + 2), ' ') FOR i IN range(1, len(w) - 1)] END) AS g FROM d),
t AS (SELECT doc_id, unnest(g) AS token, len(g) AS n FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b FROM t x JOIN t y ON x.token = y.token AND x.doc_id <> y.doc_id
        AND 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
      GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS id, doc_id AS to_id FROM d UNION SELECT r.id, p.b FROM r JOIN p ON r.to_id = p.a),
c AS (SELECT id, min(to_id) AS component_id FROM r GROUP BY id)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, component_id FROM s JOIN c ON c.id = s.doc_id"""


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items."""
    f = decontaminate.find(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return f.select(F.col("id").cast("long").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def sql_op11() -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    size = decontaminate.WINDOW
    return f"""
WITH b AS (SELECT item_id::VARCHAR AS item, {words} AS w FROM benchmark),
p AS (SELECT item, w, least(len(w), {size}) AS n, unnest(range(1, greatest(len(w) - {size}, 0) + 2)) AS i FROM b WHERE len(w) > 0),
k AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS key FROM p),
d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
q AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM k) WHERE len(w) >= n),
m AS (SELECT rid, i, q.n, item FROM q JOIN k ON k.n = q.n AND k.key = array_to_string(list_slice(w, i, i + q.n - 1), ' ')),
h AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS pos FROM m) GROUP BY rid),
g AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM m WHERE item IS NOT NULL)
      GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN g USING (rid)"""


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of all words, after one letter of every 199th run is lost."""
    def lose(doc: Column, run: Column) -> Column:
        h = F.crc32(F.concat(doc, F.lit(":"), run).cast("binary"))
        at = F.pmod(h, F.length(run)).cast("int")
        return F.when(h % 199 == 0, F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))).otherwise(run)
    return spelling.variants(documents(spark, sf_dir), lose)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups and links of two tokenisers over every document."""
    return alignment.align(documents(spark, sf_dir))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_orc": op2_token_orc,
    "op3_mix_sources": op3_mix_sources,
    "op4_quality_rank": op4_quality_rank,
    "op5_language_id": op5_language_id,
    "op6_license_scan": op6_license_scan,
    "op7_pii_spans": op7_pii_spans,
    "op8_exact_topk": op8_exact_topk,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_decontaminate": op11_decontaminate,
    "op12_spelling": op12_spelling,
    "op13_alignment": op13_alignment,
}

ORACLE = {
    "op1_quality_rules": sql_op1,
    "op3_mix_sources": sql_op3,
    "op8_exact_topk": sql_op8,
    "op10_ngram_jaccard": sql_op10,
    "op11_decontaminate": sql_op11,
}
