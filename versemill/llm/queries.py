"""The numbered queries: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versemill.llm import bpe, chat, decontam, lines, lm, mixing, phrases, quality, runs, secrets, setjoin, toxicity, warc
from versemill.llm.common import WORD, id_remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Words in DuckDB's regular expressions.
WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


@query("op1_latent_leaks")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, item_id) of every benchmark item found in a document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontam.with_leaks(docs, table(spark, folder, "benchmark"))
    leaks = found.select("doc_id", F.explode("leaks").alias("leak"))
    return leaks.select(
        "doc_id", F.col("leak.item").alias("item_id"), F.col("leak.share").alias("lcs_share"), F.col("leak.answer").alias("answer_share")
    )


@query("op2_chat_repair")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn of `conversations` with its repair and its piece of the rendered text."""
    return chat.repair(table(spark, folder, "conversations"))


@query("op3_fuzzy_lines")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the lines that stay."""
    docs = lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_removed", "text")


@query("op4_deleted_interpolation")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    held_out = id_remainder("doc_id", 7) == 2
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), (~held_out).alias("flag"), "text")
    scored = lm.interpolated_scores(docs)
    return scored.select(
        F.col("id").alias("doc_id"), (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query("op5_secret_scan")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    n = {k: secrets.count_kind("spans", k) for k in secrets.KINDS}
    return found.select(
        F.col("id").alias("doc_id"),
        *[n[k].alias(f"n_{k}") for k in secrets.KINDS[:3]],
        F.sha2(secrets.joined("base"), 256).alias("base_sha256"),
        secrets.joined("spans").alias("spans"),
        n["entropy"].alias("n_entropy"),
    )


@query(
    "op6_host_quality",
    rf"""
WITH d AS (SELECT row_number() OVER () rid, doc_id, source, coalesce("text", '') t FROM documents),
w AS (SELECT rid, doc_id, source, {WORDS} ws, t,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) ls FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i+7], ' ') g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) n FROM rep, range(0, 8) r(k) GROUP BY rid),
c AS (SELECT w.doc_id, w.source, len(ws)::BIGINT n_words, coalesce(length(array_to_string(ws, '')), 0)::BIGINT word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT n_dup_lines, coalesce(cov.n, 0)::BIGINT n_repeat_words
      FROM w LEFT JOIN cov USING (rid)),
j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words base_failed FROM c),
h AS (SELECT source, count(*) n, sum(base_failed::INT) f FROM j GROUP BY source),
m AS (SELECT sum(f) / sum(n) mean, sum(n * (f / n) * (f / n)) / sum(n) sq, count(*) / sum(n) per FROM h),
p AS (SELECT mean, sq - mean * mean - mean * (1 - mean) * per between_hosts FROM m),
v AS (SELECT source, CASE WHEN between_hosts > 0 THEN
        (f + greatest(mean * (1 - mean) / between_hosts - 1, 0) * mean) / (n + greatest(mean * (1 - mean) / between_hosts - 1, 0))
        ELSE mean END rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate <= 0.5 AS kept
FROM j JOIN v ON j.source IS NOT DISTINCT FROM v.source
""",
)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.apply_rules(table(spark, folder, "documents"))
    return judged.select(F.col("id").alias("doc_id"), *quality.COUNTS, "base_failed", "kept")


@query("op7_toxicity")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = id_remainder("doc_id", 5) == 0
    model = toxicity.fit(docs, table(spark, folder, "labels"), ~held_out)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query(
    "op8_jaccard_join",
    rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) g FROM d),
e AS (SELECT doc_id, len(g) n, unnest(g) x FROM s),
p AS (SELECT a.doc_id a, b.doc_id b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id u, doc_id v FROM s UNION SELECT r.u, l.b FROM r JOIN l ON r.v = l.a)
SELECT doc_id, len(g)::BIGINT n_shingles, coalesce(c, doc_id) component_id FROM s LEFT JOIN (SELECT u, min(v) c FROM r GROUP BY u) ON u = doc_id
""",
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    groups = setjoin.near_groups(table(spark, folder, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query(
    "op9_warc_captures",
    """
WITH p AS (SELECT page_id, coalesce(html, '') t FROM pages),
g AS (SELECT t, max(page_id) first_id FROM p WHERE strlen(t) >= 1000 GROUP BY t)
SELECT page_id, strlen(p.t)::BIGINT payload_bytes, sha1(p.t) payload_digest,
       CASE WHEN g.t IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END record_type,
       CASE WHEN g.t IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END refers_to
FROM p LEFT JOIN g ON p.t = g.t
""",
)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    captures = warc.round_trip(table(spark, folder, "pages"))
    return warc.capture_digests(captures)


@query(
    "op10_source_mix",
    rf"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT size,
             substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {mixing.DIGITS * mixing.LEVELS}) digest
           FROM (SELECT doc_id, source, coalesce("text", '') t FROM documents)),
s AS (SELECT source, sum(size)::BIGINT source_size FROM d GROUP BY source),
k AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 weight FROM s),
r AS (SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0) rest, sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) open_weight,
        row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) rn
      FROM k WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT coalesce(arg_min(rest::DOUBLE / open_weight::DOUBLE, rn), 0) level FROM r WHERE 3 * source_size >= rest::DOUBLE / open_weight::DOUBLE * weight),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, level * weight) target FROM k, l),
w AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END whole FROM t),
c AS (SELECT d.doc_id, d.size, w.source_size, w.target, whole, target - whole * source_size part,
        sum(size) OVER (PARTITION BY d.source ORDER BY digest) upto, sum(size) OVER (PARTITION BY d.source, digest) same
      FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source),
e AS (SELECT *, CASE WHEN upto <= part THEN 1 WHEN upto - same <= part AND 2 * (part - upto + same) > same THEN 1 ELSE 0 END extra FROM c)
SELECT doc_id, size, source_size, target, (least(whole + extra, 3) * size)::BIGINT taken FROM e
""",
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op11_collocations",
    r"""
WITH p AS (SELECT coalesce(lang, 'und') lang, unnest(string_split_regex(translate(coalesce("text", ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) s FROM documents),
w AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') ws FROM p),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) i FROM w),
g AS (SELECT lang, k, array_to_string(ws[i:i+k-1], ' ') g, count(*) f FROM i, (VALUES (1), (2), (3)) s(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL),
t AS (SELECT lang, sum(len(ws))::BIGINT n FROM w GROUP BY lang),
c AS (SELECT lang, k, g, f, string_split(g, ' ') ws FROM g WHERE k > 1 AND f >= 10),
u AS (SELECT c.*, unnest(range(1, k)) cut FROM c),
s AS (SELECT u.lang, u.k, u.g, u.f a, cut, x.f l, y.f r, ((1000000::HUGEINT * u.f * u.f) // (x.f::HUGEINT * y.f))::BIGINT score
      FROM u JOIN g x ON x.lang = u.lang AND x.g = array_to_string(ws[1:cut], ' ')
             JOIN g y ON y.lang = u.lang AND y.g = array_to_string(ws[cut+1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
o AS (SELECT lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) g, f FROM c WHERE k = 3),
m AS (SELECT lang, g, max(f) f FROM o GROUP BY lang, g),
k AS (SELECT b.* FROM b LEFT JOIN m ON b.lang = m.lang AND b.g = m.g WHERE m.f IS NULL OR 100 * m.f < 50 * b.a)
SELECT lang, row_number() OVER q AS "rank", g AS phrase, a, l, r, n, score FROM k JOIN t USING (lang)
WINDOW q AS (PARTITION BY lang ORDER BY score DESC, a DESC, g) QUALIFY row_number() OVER q <= 2000
""",
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def with_periods(docs: DataFrame) -> DataFrame:
    """`documents` in which the texts of a tenth of the ids go round from some word on."""
    h = id_remainder("doc_id", 1 << 32)
    g = F.floor(h / 10)
    held = docs.select("doc_id", h.alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    held = held.withColumn("words", words).withColumn("n", F.size("words")).withColumn("g", g)
    a = (F.col("g") % F.col("n")).cast("int")
    p = (1 + F.floor((F.col("n") - a) / (3 + F.col("g") % 8))).cast("int")
    left = F.col("n") - a
    turns = F.array_repeat(F.slice("words", a + 1, p), F.ceil(left / p).cast("int"))
    turned = F.concat(F.slice("words", F.lit(1), a), F.slice(F.flatten(turns), F.lit(1), left))
    return held.select("doc_id", F.when(F.col("n") > 0, F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_lyndon_runs")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.collapse_runs(with_periods(table(spark, folder, "documents")))
    rows = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.expr("1000 * best.length div best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(rows, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_byte_pairs")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.Ranks.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), ranks)
    return ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )
