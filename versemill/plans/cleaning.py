"""Projections, filters, cleaning and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from versemill.functions import parsing, text
from versemill.operators import cleaning, packing
from versemill.plans.registry import query, table
from versemill.plans.views import SONGS, songs, sql_hash, sql_unit
from versemill.functions.scalars import hash_key, hash_unit


@query("label_lower_yes", f"WITH {SONGS} SELECT doc_id, CASE WHEN lower(explicit) = 'yes' THEN 1 ELSE 0 END AS label FROM songs")
def label_lower_yes(spark, folder):
    return songs(spark, folder).select("doc_id", parsing.label_lower_yes(F.col("explicit")).alias("label"))


@query("label_map", f"WITH {SONGS} SELECT doc_id, CASE explicit WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS label FROM songs")
def label_map(spark, folder):
    return songs(spark, folder).select("doc_id", parsing.label_map(F.col("explicit")).alias("label"))


@query(
    "combine_text",
    f"""WITH {SONGS} SELECT doc_id, coalesce(emotion, '') || ' ' || coalesce(artist, '') || ' ' || coalesce(genre, '')
          || ' ' || coalesce(text, '') AS combined FROM songs""",
)
def combine_text(spark, folder):
    columns = [F.col(c) for c in ("emotion", "artist", "genre", "text")]
    return songs(spark, folder).select("doc_id", text.combine_text(*columns).alias("combined"))


@query("parse_loudness", f"WITH {SONGS} SELECT doc_id, try_cast(replace(loudness, 'db', '') AS DOUBLE) AS loudness FROM songs")
def parse_loudness(spark, folder):
    return songs(spark, folder).select("doc_id", parsing.parse_loudness(F.col("loudness")).alias("loudness"))


@query(
    "parse_length",
    f"""WITH {SONGS} SELECT doc_id, split_part(length, ':', 1)::INTEGER * 60 + split_part(length, ':', 2)::INTEGER AS seconds
        FROM songs""",
)
def parse_length(spark, folder):
    return songs(spark, folder).select("doc_id", parsing.parse_length(F.col("length")).alias("seconds"))


_DATE = "try_strptime(regexp_replace(release_date, '(\\d+)(st|nd|rd|th)', '\\1'), '%d %B %Y')"


@query(
    "parse_release_date",
    f"""WITH {SONGS}, dated AS (SELECT doc_id, {_DATE} AS d FROM songs)
        SELECT doc_id, year(d)::INTEGER AS release_year, month(d)::INTEGER AS release_month,
          day(d)::INTEGER AS release_day FROM dated""",
)
def parse_release_date(spark, folder):
    dated = songs(spark, folder).select("doc_id", parsing.parse_release_date(F.col("release_date")).alias("d"))
    return dated.select(
        "doc_id",
        F.year("d").alias("release_year"),
        F.month("d").alias("release_month"),
        F.dayofmonth("d").alias("release_day"),
    )


@query(
    "ordinal_suffixes",
    f"""WITH {SONGS} SELECT DISTINCT nullif(regexp_extract(release_date, '\\d+(st|nd|rd|th)', 1), '') AS suffix FROM songs""",
)
def ordinal_suffixes(spark, folder):
    return songs(spark, folder).select(parsing.ordinal_suffix(F.col("release_date")).alias("suffix")).distinct()


@query(
    "release_decade",
    f"""WITH {SONGS}, dated AS (SELECT doc_id, {_DATE} AS d FROM songs)
        SELECT doc_id, (coalesce(year(d), 0) // 10 * 10) || 's' AS decade FROM dated""",
)
def release_decade(spark, folder):
    date = parsing.parse_release_date(F.col("release_date"))
    return songs(spark, folder).select("doc_id", parsing.release_decade(date).alias("decade"))


@query(
    "fill_zero",
    f"WITH {SONGS} SELECT doc_id, coalesce(popularity, 0) AS popularity, coalesce(energy, 0.0)::DOUBLE AS energy, tempo FROM songs",
)
def fill_zero(spark, folder):
    rows = songs(spark, folder).select("doc_id", "popularity", "energy", "tempo")
    return cleaning.fill_zero(rows, ["popularity", "energy", "tempo"])


@query(
    "fill_unknown",
    f"WITH {SONGS} SELECT doc_id, coalesce(genre, 'unknown') AS genre, coalesce(emotion, 'unknown') AS emotion FROM songs",
)
def fill_unknown(spark, folder):
    return cleaning.fill_unknown(songs(spark, folder).select("doc_id", "genre", "emotion"), ["genre", "emotion"])


@query("drop_null_rows", f"WITH {SONGS} SELECT doc_id, explicit, genre FROM songs WHERE explicit IS NOT NULL AND genre IS NOT NULL")
def drop_null_rows(spark, folder):
    return songs(spark, folder).select("doc_id", "explicit", "genre").na.drop(subset=["explicit", "genre"])


@query(
    "percent_to_fraction",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount,
         round(try_cast(rtrim(replace(replace((l_discount * 100)::INTEGER || '.25%', '.', ','), ',', '.'), '%') AS DOUBLE) / 100, 6) AS fraction
       FROM lineitem""",
)
def percent_to_fraction(spark, folder):
    lines = table(spark, folder, "lineitem")
    shown = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit(",25%"))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", F.round(parsing.percent_to_fraction(shown), 6).alias("fraction")
    )


_DROP = f"{sql_unit(sql_hash('drop', 'doc_id'))} < 0.05"


def _drop_list(docs):
    return docs.filter(hash_unit(hash_key("drop", F.col("doc_id"))) < 0.05).select("doc_id")


@query(
    "drop_listed_rows",
    f"SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM documents WHERE NOT ({_DROP})",
)
def drop_listed_rows(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    return cleaning.drop_listed_rows(docs, _drop_list(docs), "doc_id")


@query(
    "select_listed_rows",
    """SELECT row_number() OVER (ORDER BY doc_id) AS pos, doc_id, n_chars FROM documents JOIN labels USING (doc_id)""",
)
def select_listed_rows(spark, folder):
    listed = cleaning.number_by_id(table(spark, folder, "labels").select("doc_id"), "doc_id", "pos")
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    return cleaning.select_listed_rows(docs, listed, "doc_id").select("pos", "doc_id", "n_chars")


@query("drop_columns", f"WITH {SONGS} SELECT * EXCLUDE (text, loudness, energy) FROM songs")
def drop_columns(spark, folder):
    return songs(spark, folder).drop("text", "loudness", "energy")


# Column names and whether they are numeric, as DuckDB's own type names give them.
def _sql_counts(name: str, texts: list[str], numbers: list[str]) -> str:
    rows = [f"SELECT '{c}' AS \"column\", false AS num, count(DISTINCT {c}) AS n FROM {name}" for c in texts]
    rows += [f"SELECT '{c}', true, 0 FROM (SELECT 1)" for c in numbers]
    return " UNION ALL ".join(rows)


_CUSTOMER = _sql_counts("customer", ["c_name", "c_mktsegment"], ["c_custkey", "c_nationkey", "c_acctbal"])
_ORDERS = _sql_counts(
    "orders", ["o_orderstatus", "o_orderpriority", "o_orderdate"], ["o_orderkey", "o_custkey", "o_totalprice"]
)


@query(
    "column_roles",
    f"""SELECT "column", CASE WHEN num THEN 'numeric' WHEN n < 100 THEN 'categorical' ELSE 'textual' END AS role
        FROM ({_CUSTOMER} UNION ALL {_ORDERS})""",
)
def column_roles(spark, folder):
    both = [cleaning.column_roles(table(spark, folder, "customer"), 100)]
    both.append(cleaning.column_roles(table(spark, folder, "orders"), 100))
    return both[0].unionByName(both[1])


_TOLERANCES = [10, 20, 50, 100, 200, 1000, 10000]


@query(
    "column_role_sweep",
    f"""SELECT t::INTEGER AS tolerance, count(*) FILTER (NOT num AND n < t) AS categorical,
          count(*) FILTER (NOT num AND n >= t) AS textual, count(*) FILTER (num) AS numeric
        FROM ({_CUSTOMER}), (SELECT unnest({_TOLERANCES}) AS t) GROUP BY t""",
)
def column_role_sweep(spark, folder):
    return cleaning.column_role_sweep(table(spark, folder, "customer"), _TOLERANCES)


_PROFILED = ["doc_id", "genre", "emotion", "loudness", "length", "release_date", "popularity", "energy", "tempo"]
_EXPECTED = ["loudness", "length", "release_date", "popularity", "energy", "tempo"]
_FOUND = " UNION ALL ".join(
    f"SELECT '{c}' AS name FROM songs HAVING count({c}) = count(try_cast({c} AS DOUBLE))" for c in _PROFILED
)


@query(
    "schema_diff",
    f"""WITH {SONGS}, found AS ({_FOUND}), expected AS (SELECT unnest({_EXPECTED}) AS name)
        SELECT coalesce(e.name, f.name) AS name, CASE WHEN e.name IS NULL THEN 'only_actual'
          WHEN f.name IS NULL THEN 'only_expected' ELSE 'both' END AS side
        FROM expected e FULL JOIN found f ON e.name = f.name""",
)
def schema_diff(spark, folder):
    """Columns thought to be numeric against those whose values are."""
    found = cleaning.numeric_columns(songs(spark, folder).select(*_PROFILED))
    expected = spark.createDataFrame([(c,) for c in _EXPECTED], "name string")
    return cleaning.schema_diff(expected, found)


@query(
    "set_difference",
    """SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus = 'F'
       EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""",
)
def set_difference(spark, folder):
    ids = lambda s: table(spark, folder, "orders").filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("id"))
    return ids("F").join(ids("P"), "id", "left_anti").distinct()


@query(
    "same_keys",
    """WITH a AS (SELECT row_number() OVER (ORDER BY doc_id) AS pos, doc_id FROM documents),
         b AS (SELECT row_number() OVER (ORDER BY doc_id) AS pos, doc_id FROM labels)
       SELECT count(*) AS n_positions, (count(*) FILTER (a.doc_id IS DISTINCT FROM b.doc_id))::BIGINT AS n_mismatch,
         count(*) FILTER (a.doc_id IS DISTINCT FROM b.doc_id) = 0 AS identical
       FROM a FULL JOIN b ON a.pos = b.pos""",
)
def same_keys(spark, folder):
    numbered = lambda name: cleaning.number_by_id(table(spark, folder, name).select("doc_id"), "doc_id", "pos")
    return cleaning.same_keys(numbered("documents"), numbered("labels"), "pos", "doc_id")


_TAGGED = "'[Chorus 2: x] ' || text || ' [verse]' || ' [Other] [PRE-CHORUS]'"


@query(
    "strip_section_tags",
    f"SELECT doc_id, regexp_replace({_TAGGED}, '(?i)\\[(?:{'|'.join(text.SECTION_TAGS)})[^\\]]*\\]', '', 'g') AS stripped FROM documents",
)
def strip_section_tags(spark, folder):
    tagged = F.concat(F.lit("[Chorus 2: x] "), F.col("text"), F.lit(" [verse]"), F.lit(" [Other] [PRE-CHORUS]"))
    return table(spark, folder, "documents").select("doc_id", text.strip_section_tags(tagged).alias("stripped"))


@query("token_estimate", "SELECT doc_id, length(text) // 4 AS tokens FROM documents")
def token_estimate(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.token_estimate(F.col("text")).alias("tokens"))


_TOKEN_LIMIT = 1500


@query("over_limit_rows", f"SELECT doc_id, length(text) // 4 AS tokens FROM documents WHERE length(text) // 4 > {_TOKEN_LIMIT}")
def over_limit_rows(spark, folder):
    return token_estimate(spark, folder).filter(F.col("tokens") > _TOKEN_LIMIT)


@query(
    "pack_batches",
    """WITH b AS (SELECT doc_id, octet_length(encode(text)) AS bytes FROM documents),
         p AS (SELECT doc_id, bytes, row_number() OVER (ORDER BY doc_id) - 1 AS before,
           sum(bytes) OVER (ORDER BY doc_id) - bytes AS bytes_before FROM b)
       SELECT doc_id, bytes::BIGINT AS bytes, dense_rank() OVER (ORDER BY before // 150, bytes_before // 400000) AS batch FROM p""",
)
def pack_batches(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"))
    return cleaning.pack_batches(docs, "doc_id", "bytes", 150, 400_000).select("doc_id", "bytes", "batch")


@query(
    "pack_batches_greedy",
    """WITH RECURSIVE p AS (SELECT doc_id, octet_length(encode(text)) AS bytes, row_number() OVER (ORDER BY doc_id) - 1 AS i,
           sum(octet_length(encode(text))) OVER (ORDER BY doc_id) AS upto FROM documents),
         opens AS (SELECT 0::BIGINT AS i, 1::BIGINT AS batch
           UNION ALL SELECT min(q.i)::BIGINT, any_value(o.batch) + 1 FROM opens o JOIN p s ON s.i = o.i
             JOIN p q ON q.i > s.i AND (q.i >= s.i + 150 OR q.upto - (s.upto - s.bytes) > 400000) GROUP BY o.i)
       SELECT doc_id, bytes::BIGINT AS bytes, batch FROM p ASOF JOIN opens ON p.i >= opens.i""",
)
def pack_batches_greedy(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"))
    return packing.pack_greedy(docs, "doc_id", "bytes", 150, 400_000).select("doc_id", "bytes", "batch")


@query(
    "sigmoid_clip",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount,
         round(1.0::DOUBLE / (1.0::DOUBLE + exp(-greatest(least((l_quantity - 25) * 30, 500.0::DOUBLE), -500.0::DOUBLE))), 9) AS p
       FROM lineitem""",
)
def sigmoid_clip(spark, folder):
    from versemill.functions.scalars import sigmoid_clip as sigmoid

    z = (F.col("l_quantity") - 25) * 30
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", F.round(sigmoid(z), 9).alias("p")
    )
