"""Registered queries of the corpus operators: each applies its operator, with
production parameters, to whole tables. ``QUERIES`` and ``ORACLES`` are merged
into the driver's lists by ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import suffix_dedup
    return suffix_dedup(table(spark, sf_dir, "documents"), keep_text=False).select(
        "rest.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


_OP2_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') t, row_number() OVER () rid FROM documents),
l AS (SELECT rid, unnest(string_split(t, chr(10))) line, generate_subscripts(string_split(t, chr(10)), 1) k FROM d),
m AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') w,
        length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) symbols,
        length(line) - length(replace(line, '|', '')) bars,
        length(line) - length(regexp_replace(line, '[!?]', '', 'g')) marks FROM l),
r AS (SELECT rid, line, k, len(w) n, CASE
        WHEN bars * 200 > 50 * len(w) AND bars * 2 > symbols THEN 2
        WHEN symbols * 100 > 50 * len(w) THEN 1
        WHEN marks * 100 > 50 * len(w) THEN 1
        WHEN len(w) >= 4 AND line = upper(line) AND line <> lower(line) THEN 2
        WHEN len(w) >= 20 AND len(list_distinct(w)) * 100 < 25 * len(w) THEN 3
        WHEN length(line) <= 300 AND regexp_matches(lower(line), 'PHRASES') THEN 3
        ELSE 0 END AS failed FROM m WHERE len(w) > 0),
a AS (SELECT rid, count(*) - count(DISTINCT line) n_dup_lines, sum(length(line)) chars FROM r GROUP BY rid),
p AS (SELECT rid, sum(length(line)) passed FROM (SELECT DISTINCT rid, line FROM r WHERE failed = 0) GROUP BY rid),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') w, t, doc_id FROM d),
g AS (SELECT rid, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] g
      FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) i FROM w)),
h AS (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) nxt
      FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) c FROM g) WHERE c > 1),
q AS (SELECT rid, sum(least(3, coalesce(nxt - i, 3))) n_repeat_words FROM h GROUP BY rid),
f AS (SELECT doc_id, len(w) n_words, length(array_to_string(w, '')) word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) n_symbols,
        coalesce(n_dup_lines, 0) n_dup_lines, coalesce(n_repeat_words, 0) n_repeat_words,
        coalesce(chars, 0) chars, coalesce(passed, 0) passed
      FROM w LEFT JOIN a USING (rid) LEFT JOIN p USING (rid) LEFT JOIN q USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) n_words, CAST(word_chars AS BIGINT) word_chars, CAST(n_symbols AS BIGINT) n_symbols,
  CAST(n_dup_lines AS BIGINT) n_dup_lines, CAST(n_repeat_words AS BIGINT) n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (chars - passed) <= 30 * chars AS kept
FROM f"""


def _op2_sql() -> str:
    from .quality_rules import PHRASES
    return _OP2_SQL.replace("PHRASES", PHRASES)


@query("op2_quality_rules", _op2_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_rules
    return quality_rules(table(spark, sf_dir, "documents"), clean_text=False).select(
        "doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines",
        "quality.n_repeat_words", "quality.base_failed", "quality.kept")


@query("op5_histogram_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .histogram_shards import histogram_shards
    return histogram_shards(table(spark, sf_dir, "documents"))


@query("op9_jaccard_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_lengths
    return pack_lengths(table(spark, sf_dir, "documents"))


@query("op10_topk_search", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk_search import exact_topk
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk(vectors, vectors.filter("vec_id % 50 = 0"))


def _fold(spark: SparkSession, sf_dir: str, parts: int, held: int) -> DataFrame:
    """Documents with ``text`` and ``held_out``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == held, F.lit(False)))


def _training(spark: SparkSession, sf_dir: str, label: str, parts: int, held: int) -> DataFrame:
    """Labelled training rows: ``doc_id, text, <label>``, one for each id."""
    labels = table(spark, sf_dir, "labels").select("doc_id", label).dropna().dropDuplicates(["doc_id"])
    return _fold(spark, sf_dir, parts, held).filter("not held_out and text is not null").join(labels, "doc_id").select("doc_id", "text", label)


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit_toxicity, toxic_spans
    field = fit_toxicity(_training(spark, sf_dir, "toxic", 4, 2))
    scored = toxic_spans(table(spark, sf_dir, "documents"), field)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "spans")


@query("op4_pu_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pu_quality import fit_pu, score_rows, text_features
    docs = table(spark, sf_dir, "documents")
    x = materialize(text_features(docs))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").dropna().dropDuplicates(["doc_id"])
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    rows = x.join(labels, "doc_id", "left").select("doc_id", "x", held.alias("held_out"), F.coalesce(
        (F.col("quality") == 1) & ~held, F.lit(False)).alias("positive"))
    model, _ = fit_pu(rows)
    scored = score_rows(x.withColumn("held_out", held), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op7_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import check_surrogates, replace_pii
    return check_surrogates(replace_pii(table(spark, sf_dir, "documents"), key="corpus-release-1")).select("doc_id", "text", "pii")


@query("op6_pieces")
def op6(spark: SparkSession, sf_dir: str, model: str = "/opt/tokenizers/piece_bpe_32k.model") -> DataFrame:
    from .pieces import Vocabulary, encode_pieces
    with open(model, "rb") as f:                     # read by the driver alone
        vocabulary = Vocabulary.from_sentencepiece(f.read())
    return encode_pieces(table(spark, sf_dir, "documents"), vocabulary, check=True)


@query("op12_byte_bpe")
def op12(spark: SparkSession, sf_dir: str, ranks: str | None = None) -> DataFrame:
    import public_tokenizers

    from .byte_bpe import ByteBpe, encode_byte_bpe
    # the rank file is read by the driver alone
    bpe = ByteBpe.from_file(ranks or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = encode_byte_bpe(table(spark, sf_dir, "documents").select("doc_id", "text"), bpe, decoded=True)
    return encoded.select("doc.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op13_filter_audit", r"""
WITH d AS (SELECT doc_id, coalesce(source, '') part, coalesce(text, '') t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') w FROM d),
m AS (SELECT t, min(doc_id) least_id FROM d GROUP BY t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, CASE WHEN len(w) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * (length(w.t) - length(regexp_replace(w.t, '[A-Z]', '', 'g'))) > 5 * length(w.t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN w.doc_id > least_id THEN 'E' ELSE '' END fails,
        coalesce(good, 0) good, coalesce(toxic, 0) toxic
      FROM w JOIN m ON w.t = m.t LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (SELECT part, fails, count(*) n, sum(good) good, sum(toxic) toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x filter_order FROM x a, x b, x c, x d, x e
      WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) own, substr(filter_order, 1, step - 1) before
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) step) k),
r AS (SELECT part, filter_order, step, own, n, good, toxic, contains(fails, own) hit, fails = own only_own,
        before <> '' AND regexp_matches(fails, '[' || before || '_]') gone FROM c, s),
g AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) kept,
        sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END) removed, sum(CASE WHEN gone AND hit THEN n ELSE 0 END) redundant,
        sum(CASE WHEN only_own THEN n ELSE 0 END) unique_fails, sum(CASE WHEN NOT gone AND hit THEN good ELSE 0 END) good_lost,
        sum(CASE WHEN NOT gone AND hit THEN toxic ELSE 0 END) toxic_lost
      FROM r GROUP BY part, filter_order, step, own),
h AS (SELECT part, own, sum(removed) shapley FROM g GROUP BY part, own)
SELECT part, filter_order, CAST(step AS INTEGER) step, CAST(kept AS BIGINT) kept, CAST(removed AS BIGINT) removed,
  CAST(redundant AS BIGINT) redundant, CAST(unique_fails AS BIGINT) unique_fails, CAST(good_lost AS BIGINT) good_lost,
  CAST(toxic_lost AS BIGINT) toxic_lost, CAST(shapley AS BIGINT) shapley
FROM g JOIN h USING (part, own)""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import audit_filters, document_failures, with_marks
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1)).alias("good"), F.max((F.col("toxic") == 1)).alias("toxic"))
    rows = with_marks(document_failures(table(spark, sf_dir, "documents")), labels)
    return audit_filters(rows, list("ABCDE"), F.col("part"), F.col("good"), F.col("toxic"), F.col("n"), ("good_lost", "toxic_lost"))


@query("op11_lexical_search", r"""
WITH t AS (SELECT doc_id, row_number() OVER () rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') w FROM documents),
d AS (SELECT rid, doc_id, len(w) size FROM t WHERE len(w) > 0),
c AS (SELECT count(*) docs, sum(size) terms FROM d),
u AS (SELECT rid, unnest(w) term FROM t),
i AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term FROM (SELECT DISTINCT item_id, text FROM benchmark) b),
q AS (SELECT item_id, term, count(*) times FROM i GROUP BY item_id, term),
p AS (SELECT rid, u.term, count(*) tf FROM u JOIN (SELECT DISTINCT term FROM q) v ON u.term = v.term GROUP BY rid, u.term),
f AS (SELECT term, count(*) df FROM p GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) w FROM f, c),
m AS (SELECT rid, doc_id, CAST(100 - 25 + ((25 * size * docs) // terms) AS BIGINT) m FROM d, c),
s AS (SELECT item_id, p.rid, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) score
      FROM q JOIN p ON q.term = p.term JOIN w ON q.term = w.term JOIN m ON p.rid = m.rid GROUP BY item_id, p.rid),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) rank
      FROM s JOIN d ON s.rid = d.rid WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) rank, doc_id, score FROM r WHERE rank <= 20""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexical_search import lexical_topk
    return lexical_topk(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
