"""The registered queries of the training-data operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm.chat import preference_pairs, swapped_answers
from tallywright.llm.circulant_minhash import circulant_minhash
from tallywright.llm.common import read_table, words_of
from tallywright.llm.exact_dedup import exact_dedup
from tallywright.llm.fill_in_middle import fill_in_middle, restored
from tallywright.llm.language_id import identify_language
from tallywright.llm.licenses import document_paths, scan_licenses
from tallywright.llm.line_dedup import line_dedup
from tallywright.llm.mixing import domain_of, mix
from tallywright.llm.ngram_join import ngram_jaccard_join
from tallywright.llm.packing import pack
from tallywright.llm.periodic_runs import periodic_runs
from tallywright.llm.quality_rules import quality_rules
from tallywright.llm.rule_ensemble import classify_quality


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(
        read_table(spark, sf_dir, "documents"), size=3, threshold=(90, 100)
    ).drop("kept")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(
        read_table(spark, sf_dir, "documents"),
        tokenizer=public_tokenizers.path("word_bpe_49k.json"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup(docs).drop("source")


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op2_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference_pairs(swapped_answers(read_table(spark, sf_dir, "conversations")))
    return pairs.withColumns({c: _listed(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


#: Token shares by domain that op1 mixes to.
TARGETS = {"good": 0.90, "low": 0.05, "toxic": 0.05}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = domain_of(read_table(spark, sf_dir, "labels"))
    return mix(read_table(spark, sf_dir, "documents"), labels, TARGETS)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(document_paths(read_table(spark, sf_dir, "documents")), carry=("doc_id",))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(read_table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash(read_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(read_table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form",
        F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def with_repeats(docs: DataFrame) -> DataFrame:
    """Every tenth document (by hash of its id) with a part of its words repeated."""
    words = words_of(F.col("text"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n, g = F.size("_words"), F.floor(F.col("_h") / 10)
    a = (F.col("_g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("_g") % 8))).cast("int")
    places = F.sequence(F.lit(0), n - 1)
    repeated = F.transform(places, lambda i: F.get("_words", F.when(i < a, i).otherwise(a + (i - a) % p)))
    return (
        docs.withColumns({"_words": words, "_h": h}).withColumn("_g", g)
        .withColumn("text", F.when((F.col("_h") % 10 == 0) & (n > 0), F.array_join(repeated, " ")).otherwise(F.col("text")))
        .drop("_words", "_h", "_g")
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeats(read_table(spark, sf_dir, "documents")))
    # the greatest length / period, compared exactly; the first of equal ones stays
    best = F.aggregate(
        F.col("runs"), F.get("runs", F.lit(0)),
        lambda top, r: F.when(r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"),
        *[F.col("_best")[part].alias(part) for part in ("start", "length", "period")],
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_preference_format": op2_preference_format,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_license_scan": op4_license_scan,
    "op5_line_dedup": op5_line_dedup,
    "op6_language_id": op6_language_id,
    "op7_packing": op7_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_minhash_near_dedup": op11_minhash_near_dedup,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_periodic_runs": op13_periodic_runs,
}
OP8_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM d JOIN g USING (text)
"""

OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT *, regexp_replace(line, '^[ \t-\r]+|[ \t-\r]+$', '', 'g') AS key FROM l),
h AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
often AS (
  SELECT source, key FROM (
    SELECT source, key, count(DISTINCT doc_id) AS c FROM k WHERE key <> '' GROUP BY source, key)
  JOIN h USING (source) WHERE c >= 2 AND c > 0.1 * n),
m AS (SELECT k.*, often.key IS NOT NULL AS gone FROM k LEFT JOIN often USING (source, key))
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
       count(*) FILTER (WHERE key <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped
FROM m GROUP BY doc_id
"""

OP2_SQL = """
WITH c AS (SELECT conv_id, turn, role, text FROM conversations),
last AS (
  SELECT conv_id, max(turn) AS pos, arg_max(text, {'a': turn, 'b': text}) AS answer
  FROM c WHERE role = 'assistant' GROUP BY conv_id),
t AS (
  SELECT conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM c
  UNION ALL
  SELECT c.conv_id, 'rejected', turn, role, text FROM c LEFT JOIN last USING (conv_id)
  WHERE pos IS NULL OR turn < pos
  UNION ALL
  SELECT l.conv_id, 'rejected', l.pos, 'assistant', o.answer
  FROM last l JOIN last o ON o.conv_id = CASE WHEN l.conv_id % 2 = 0 THEN l.conv_id + 1 ELSE l.conv_id - 1 END),
n AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) AS i FROM t),
b AS (
  SELECT coalesce(x.pair_id, y.pair_id) AS pair_id, coalesce(x.i, y.i) AS i,
         coalesce(x.role = y.role AND x.text = y.text, false) AS same
  FROM (SELECT * FROM n WHERE side = 'chosen') x
  FULL JOIN (SELECT * FROM n WHERE side = 'rejected') y ON x.pair_id = y.pair_id AND x.i = y.i),
p AS (SELECT pair_id, coalesce(min(i) FILTER (WHERE NOT same) - 1, max(i)) AS n_common FROM b GROUP BY pair_id),
r AS (
  SELECT n.*, n_common, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown
  FROM n JOIN p USING (pair_id)),
s AS (
  SELECT *, sum(length(shown)) OVER (PARTITION BY pair_id, side ORDER BY i) AS after
  FROM r WHERE i > n_common),
done AS (
  SELECT pair_id, side, string_agg(shown, '' ORDER BY i) AS body,
         string_agg((after - length(shown) + length(role) + 5)::BIGINT || '-' || (after - 1)::BIGINT, ',' ORDER BY i)
           FILTER (WHERE role = 'assistant') AS mask
  FROM s GROUP BY pair_id, side),
head AS (
  SELECT pair_id, string_agg(shown, '' ORDER BY i) AS prompt FROM r
  WHERE side = 'chosen' AND i <= n_common GROUP BY pair_id)
SELECT p.pair_id, n_common, coalesce(prompt, '') AS prompt,
       coalesce(x.body, '') AS chosen, coalesce(y.body, '') AS rejected,
       coalesce(x.mask, '') AS chosen_mask, coalesce(y.mask, '') AS rejected_mask,
       x.body IS NULL AND y.body IS NULL AS tie
FROM p LEFT JOIN head USING (pair_id)
LEFT JOIN done x ON x.pair_id = p.pair_id AND x.side = 'chosen'
LEFT JOIN done y ON y.pair_id = p.pair_id AND y.side = 'rejected'
"""

OP12_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents),
h AS (
  SELECT *, ('0x' || hex[1:8])::BIGINT AS h1, ('0x' || hex[9:16])::BIGINT AS h2,
         ('0x' || hex[17:24])::BIGINT AS h3, ('0x' || hex[25:32])::BIGINT AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (
  SELECT *, CASE form
    WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || text[1:a] || '<S>' || text[b + 1:] || '<M>' || text[a + 1:b]
    ELSE '<S>' || text[b + 1:] || '<P>' || text[1:a] || '<M>' || text[a + 1:b] END AS output FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(output) AS output_sha256, sha256(text) AS restored_sha256
FROM o
"""

ORACLES: dict[str, str] = {
    "op2_preference_format": OP2_SQL,
    "op5_line_dedup": OP5_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op12_fill_in_middle": OP12_SQL,
}
