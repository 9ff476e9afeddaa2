"""Queries on documents as free-text lists and instrument files, and on labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from longitab.functions import text as TX
from longitab.operators import joins as J
from longitab.operators import reshape as R
from longitab.plans import history as H
from longitab.plans.instruments import missing_files
from longitab.session import fresh_path
from longitab.sources import delimited, files

from .derive import LISTS, WS, lists
from .registry import query

# Words that the texts do hold, in the roles of body regions, sides and surgeries.
REGIONS = "ther|sch|eaux|ción"
SIDE = "ing|ion|er"
SURGERY = "the|der|les|las"
GRAFT = "der"


def _trim(e):
    return f"trim({e}, {WS})"


# -- splitting -------------------------------------------------------------

@query(f"WITH {LISTS} SELECT id, unnest(string_split(list, ';')) AS list FROM lists "
       "UNION ALL SELECT -1 - doc_id, NULL FROM labels")
def explode_delimited(load):
    """A null list stays one null row; empty entries stay.  Labels add the ids without a list."""
    none = load("labels").select((-1 - F.col("doc_id")).alias("id"), F.lit(None).cast("string").alias("list"))
    return R.explode_list(lists(load).select("id", "list").unionByName(none), "list")


@query(f"WITH {LISTS}, p AS (SELECT id, string_split(list, ';')[1:8] AS parts FROM lists) SELECT id, "
       + ", ".join(f"parts[{i}] AS med{i}" for i in range(1, 9)) + " FROM p")
def split_to_columns(load):
    return R.split_columns(lists(load).select("id", "list"), "list", [f"med{i}" for i in range(1, 9)])


@query(f"""WITH {LISTS}, p AS (SELECT id, string_split(list, ';')[1:8] AS parts FROM lists)
SELECT id, CAST(i - 1 AS INTEGER) AS pos, parts[i] AS list FROM (
  SELECT id, parts, unnest(generate_series(1, len(parts))) AS i FROM p)""")
def explode_first_n(load):
    return R.explode_first(lists(load).select("id", "list"), "list", 8, pos="pos")


# -- cleaning --------------------------------------------------------------

NORMAL = r"translate(regexp_replace(regexp_replace(list, '[0-9]', '', 'g'), '\([^)]+\)', '', 'g'), ',', ';')"


@query(f"WITH {LISTS} SELECT id, regexp_replace({NORMAL}, ';$', '') AS list FROM lists")
def normalise_list_text(load):
    return lists(load).select("id", TX.normalise_list("list").alias("list"))


@query("SELECT doc_id, regexp_replace(text, '[aeiou]+', '_', 'g') AS replaced, regexp_replace(text, '[0-9]|/', '', 'g') AS removed FROM documents")
def regex_replace_all(load):
    return load("documents").select("doc_id", TX.replace_all("text", "[aeiou]+", "_").alias("replaced"),
                                    TX.replace_all("text", r"\d|/").alias("removed"))


@query("SELECT doc_id, regexp_replace(text, '(the|er|es)', '[$1]') AS once FROM documents")
def regex_replace_first(load):
    return load("documents").select("doc_id", TX.replace_first("text", "the|er|es", "[$1]").alias("once"))


@query(f"SELECT doc_id, {_trim(f'''chr(9) || chr(160) || text || ' ' || chr(10) || chr(8195)''')} AS text FROM documents")
def trim_whitespace(load):
    padded = F.concat(F.lit("\t "), F.col("text"), F.lit(" \n "))
    return load("documents").select("doc_id", TX.trim_all(padded).alias("text"))


@query("""SELECT source, count(*) AS n, count(*) FILTER (WHERE regexp_matches(text, 'license|License')) AS n_license,
  count(*) FILTER (WHERE regexp_matches(text, '[0-9]{3}')) AS n_number FROM documents GROUP BY source""")
def conditional_counts(load):
    text = F.col("text")
    return load("documents").groupBy("source").agg(
        F.count("*").alias("n"), F.count_if(text.rlike("license|License")).alias("n_license"),
        F.count_if(text.rlike(r"\d{3}")).alias("n_number"))


# -- histories -------------------------------------------------------------

HISTORY = rf"""parts AS (SELECT id, string_split(translate(regexp_replace(list, '[0-9]', '', 'g'), ',', ';'), ';') AS parts FROM lists),
tok AS (SELECT id, CAST(i - 1 AS INTEGER) AS pos, {_trim("parts[i]")} AS token
  FROM (SELECT id, parts, unnest(generate_series(1, len(parts))) AS i FROM parts))"""
SURGERIES = f"""parts AS (SELECT id, string_split(regexp_replace({NORMAL}, ';$', ''), ';') AS parts FROM lists),
tok AS (SELECT id, CAST(i - 1 AS INTEGER) AS pos, {_trim("parts[i]")} AS token
  FROM (SELECT id, parts, unnest(generate_series(1, len(parts))) AS i FROM parts))"""


@query(f"WITH {LISTS}, {HISTORY} SELECT token AS f, count(*) AS n FROM tok GROUP BY 1")
def token_frequency(load):
    return H.token_frequency(H.history_tokens(lists(load), "list"))


@query(f"""WITH {LISTS}, {HISTORY},
hit AS (SELECT id, pos, {_trim(f"regexp_replace(token, '{SIDE}', '')")} AS token FROM tok WHERE regexp_matches(token, '{REGIONS}'))
SELECT id, min(pos) AS pos, token FROM hit GROUP BY id, token""")
def token_filter_distinct(load):
    return H.body_region_tokens(H.history_tokens(lists(load), "list"), regions=REGIONS, side=SIDE)


@query(f"""WITH {LISTS}, {SURGERIES}, known AS (SELECT * FROM tok WHERE regexp_matches(token, '{SURGERY}') OR regexp_matches(token, '{GRAFT}')),
agg AS (SELECT id, nullif(count(*) FILTER (WHERE regexp_matches(token, '{SURGERY}')), 0) AS n_surgery,
    count(*) FILTER (WHERE regexp_matches(token, '{SURGERY}') AND contains(token, 'index')) AS n_index,
    count(*) FILTER (WHERE regexp_matches(token, '{SURGERY}') AND contains(token, 'contra')) AS n_contra FROM known GROUP BY id),
grafts AS (SELECT id, string_agg(token || ': ' || n, '; ' ORDER BY token) AS grafts FROM (
  SELECT id, token, count(*) AS n FROM known WHERE regexp_matches(token, '{GRAFT}') GROUP BY id, token) GROUP BY id)
SELECT lists.id, n_surgery, CASE WHEN n_surgery > 0 THEN n_index END AS n_indexsurgery, CASE WHEN n_surgery > 0 THEN n_contra END AS n_contrasurgery, grafts
FROM lists LEFT JOIN agg USING (id) LEFT JOIN grafts USING (id)""")
def per_id_token_profile(load):
    """Every surgery the data hold is counted; the map is shown as text."""
    df = lists(load)
    tokens = H.history_tokens(df, "list", notes=True, closing=True)
    profile = H.surgery_profile(df, tokens, any_surgery=SURGERY, graft=GRAFT, as_map=True)
    entries = F.transform(F.map_entries("grafts"), lambda e: F.concat(e["key"], F.lit(": "), e["value"].cast("string")))
    return profile.withColumn("grafts", F.array_join(entries, "; "))


@query(f"WITH {LISTS}, {SURGERIES} SELECT token AS f, count(DISTINCT id) AS n FROM tok GROUP BY 1")
def patients_per_token(load):
    return H.patients_per_token(H.history_tokens(lists(load), "list", notes=True, closing=True))


# -- instrument files ------------------------------------------------------

@query("""SELECT doc_id, string_split(text, chr(10))[1] AS name, string_split(string_split(text, chr(10))[1], ', ')[1] AS surname,
  string_split(string_split(text, chr(10))[1], ', ')[2] AS firstname FROM documents""")
def first_line_split(load):
    return files.with_names(load("documents").select("doc_id", "text")).drop("text")


@query("""SELECT lang, (doc_id % 16)::INTEGER AS bucket, count(*) AS n_lines, string_agg(doc_id || ' ' || n_chars, chr(10) ORDER BY doc_id) || chr(10) AS text
FROM documents WHERE lang <> 'de' AND doc_id % 16 NOT BETWEEN 10 AND 15 GROUP BY ALL""")
def file_scan(load):
    """Files written below folders, listed by folder and name, and read whole."""
    df = load("documents").withColumn("bucket", F.col("doc_id") % 16)
    spark, root = df.sparkSession, fresh_path(df.sparkSession)
    line = F.concat_ws(" ", F.col("doc_id").cast("string"), F.col("n_chars").cast("string"))
    (df.select("lang", "bucket", "doc_id", line.alias("value")).repartition("bucket").sortWithinPartitions("lang", "bucket", "doc_id")
     .select("lang", "bucket", "value").write.partitionBy("lang", "bucket").text(root))
    listed = files.list_files(spark, root, r"\.txt$", exclude_dirs="lang=de|bucket=1[0-5]")
    found = J.left_join(listed, files.read_whole(spark, root), "file")
    return found.select(
        F.regexp_extract("dir", "lang=([a-z]+)", 1).alias("lang"), F.regexp_extract("dir", "bucket=([0-9]+)", 1).cast("int").alias("bucket"),
        F.regexp_count("text", F.lit("\n")).cast("bigint").alias("n_lines"), "text")


# Each document as an instrument file: five lines, a header, and its lines with
# letters turned to digits, so that the second word of a line is a number.
LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "01234567890123456789012345"
PLAIN = r"regexp_replace(regexp_replace(lower(text), '[^a-z \n]', ''{g}), ' t', ' -'{g})"
BODY = f"translate({PLAIN}, '{LETTERS}', '{DIGITS}')"


@query(rf"""WITH t AS (SELECT doc_id, translate({PLAIN.format(g=", 'g'").replace(chr(92) + "n", chr(92) + "n")}, '{LETTERS}', '{DIGITS}') AS body FROM documents),
l AS (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM t),
f AS (SELECT doc_id, string_split(regexp_replace(trim(line), ' +', ' ', 'g'), ' ')[2] AS raw FROM l WHERE trim(line) <> ''),
g AS (SELECT doc_id, count(*) AS n, count(raw) AS n_raw, count(try_cast(raw AS DOUBLE)) AS n_num,
    max(try_cast(raw AS DOUBLE)) AS top, abs(min(try_cast(raw AS DOUBLE))) AS low FROM f GROUP BY doc_id)
SELECT doc_id, CASE WHEN n = n_raw THEN top END AS quad, CASE WHEN n = n_raw THEN low END AS hs FROM g WHERE n_raw = n_num
UNION ALL SELECT doc_id, CAST('-Infinity' AS DOUBLE), CAST('Infinity' AS DOUBLE) FROM t WHERE doc_id NOT IN (SELECT doc_id FROM f)""")
def instrument_extremes(load):
    body = F.expr("translate(regexp_replace(regexp_replace(lower(text), '[^a-z \\\\n]', ''), ' t', ' -'), "
                  f"'{LETTERS}', '{DIGITS}')")
    head = F.lit("Doe, Jo\n2\n3\n4\n5\nTIME N-M ANGLE\n")
    df = load("documents").select("doc_id", F.concat(head, body).alias("text"))
    return files.extremes(df)


# -- an export with line breaks --------------------------------------------

#: Bytes of text in a part of the export, which one task writes: some splits of Spark's default size.
PART_BYTES = 256 << 20


def _write_parts(df):
    """The rows by ``doc_id`` as CSV, in as many parts as their texts need; by name they follow each other."""
    path = fresh_path(df.sparkSession)
    held = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    delimited.write_csv(df.repartitionByRange(1 + held // PART_BYTES, "doc_id").sortWithinPartitions("doc_id"), path)
    return path


@query("""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS seq, doc_id, text, source, CASE WHEN n_chars % 3 > 0 THEN n_chars END AS n_chars
FROM documents""")
def scan_csv_split(load):
    """An export, cut into splits, whose texts hold line breaks and quotes; every third number is not one."""
    df = load("documents")
    number = F.when(F.col("n_chars") % 3 > 0, F.col("n_chars").cast("string")).otherwise("xx")
    path = _write_parts(df.select("doc_id", "text", "source", number.alias("n_chars")))
    return delimited.read_export(df.sparkSession, path, "doc_id BIGINT, text STRING, source STRING, n_chars BIGINT", split_bytes=0, by_name=True)


@query("""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS seq, 'n_chars' AS "column", 'no. ' || n_chars AS text
FROM documents QUALIFY n_chars % 3 = 0""")
def csv_rejects(load):
    """The fields that did not parse, from the scan that gives the table."""
    df = load("documents")
    number = F.when(F.col("n_chars") % 3 > 0, F.col("n_chars").cast("string")).otherwise(F.concat(F.lit("no. "), "n_chars"))
    path = _write_parts(df.select("doc_id", "text", number.alias("n_chars")))
    return delimited.read_checked(df.sparkSession, path, "doc_id BIGINT, text STRING, n_chars BIGINT", split_bytes=0, by_name=True).rejects


# -- labels ----------------------------------------------------------------

@query("SELECT documents.doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def left_join(load):
    return J.left_join(load("documents").select("doc_id", "lang"), load("labels"), "doc_id")


@query("SELECT documents.doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def left_join_unique(load):
    """Fails if a label occurs twice."""
    return J.left_join(load("documents").select("doc_id", "lang"), load("labels"), "doc_id", unique=True)


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_join_missing(load):
    return J.anti_join(load("documents").select("doc_id", "lang"), load("labels"), "doc_id", null_safe=True)


@query("""WITH expected AS (SELECT DISTINCT l_orderkey AS id, l_linestatus AS timepoint FROM lineitem),
found AS (SELECT l_orderkey AS id, l_linestatus AS timepoint, CASE l_returnflag WHEN 'A' THEN 'left' ELSE 'right' END AS side
  FROM lineitem WHERE l_returnflag <> 'N'),
lone AS (SELECT id, timepoint, max(side) AS side FROM found GROUP BY id, timepoint HAVING count(*) = 1)
SELECT id, timepoint, 'both' AS side FROM expected ANTI JOIN found USING (id, timepoint)
UNION ALL SELECT id, timepoint, CASE side WHEN 'left' THEN 'right' WHEN 'right' THEN 'left' END FROM lone""")
def missing_pairs(load):
    """Orders as participants: a line that was returned is a file of one side."""
    lines = load("lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linestatus").alias("timepoint"), "l_returnflag")
    side = F.when(F.col("l_returnflag") == "A", "left").otherwise("right")
    found = lines.filter("l_returnflag <> 'N'").select("id", "timepoint", side.alias("side"))
    return missing_files(lines.select("id", "timepoint").distinct(), found)
