"""Queries on page addresses seen as file paths, and on points."""

from __future__ import annotations

from pyspark.sql import functions as F

from longitab.functions.text import extract_first
from longitab.operators.spatial import assign_areas
from longitab.plans import areas as AR
from longitab.plans import instruments as IN
from longitab.sources import files

from .registry import query

EXCLUDED = "spam|/es$"

FILES = rf"""listed AS (SELECT page_id, url AS file, regexp_extract(url, '^(.*)/[^/]*$', 1) AS dir FROM pages
  WHERE regexp_matches(regexp_extract(url, '[^/]*$'), '[0-9]'))"""


@query(f"WITH {FILES} SELECT page_id, file, dir FROM listed WHERE NOT regexp_matches(dir, '{EXCLUDED}')")
def file_inventory(load):
    return files.inventory(load("pages").select("page_id", F.col("url").alias("file")), "file", r"\d", EXCLUDED)


# A page address as an instrument file: number, side and visit by its parts.
PATH = """concat('/data/', regexp_extract(url, '//([^/]+)/', 1), '/P_', {num}, '_',
  CASE WHEN url LIKE '%/en/%' THEN 'LEFT' WHEN url LIKE '%/de/%' THEN 'Right' WHEN url LIKE '%/fr/%' THEN 'right' ELSE 'none' END,
  CASE WHEN url LIKE 'https://www%' THEN '_T12' WHEN url LIKE 'https%' THEN '_T4' WHEN url LIKE 'http://www%' THEN '_T8' ELSE '' END, '.txt')"""
NUM = r"regexp_extract(url, '/([0-9]+)', 1)"
META = f"""named AS (SELECT page_id, {PATH.format(num=NUM)} AS file FROM pages),
meta AS (SELECT page_id, file, regexp_extract(file, '^(.*)/[^/]*$', 1) AS dir,
    nullif(regexp_extract(file, '/([^/.]+)\\.txt', 1), '') AS name FROM named),
parsed AS (SELECT *, try_cast(nullif(regexp_extract(name, '([0-9]+)_', 1), '') AS BIGINT) AS id,
    CASE WHEN regexp_matches(name, 'LEFT|left|Left') THEN 'left' WHEN regexp_matches(name, 'RIGHT|right|Right') THEN 'right' END AS side,
    CASE WHEN regexp_matches(name, 'T12$') THEN 'm12' WHEN regexp_matches(name, 'T4$') THEN 'm4'
      WHEN regexp_matches(name, 't$|T$') THEN 'm0' END AS timepoint FROM meta),
full_meta AS (SELECT *, CASE WHEN timepoint = 'm0' THEN 'P_' || coalesce(CAST(id AS VARCHAR), 'NA') || '_' || coalesce(upper(side), 'NA')
    WHEN timepoint <> 'm0' THEN 'P_' || coalesce(CAST(id AS VARCHAR), 'NA') || '_' || coalesce(upper(side), 'NA') || '_' || upper(replace(timepoint, 'm', 't'))
    END AS correct_name FROM parsed)"""


def _paths(load):
    path = F.expr(PATH.format(num=NUM))
    return files.inventory(load("pages").select("page_id", path.alias("file")), "file", ".txt")


@query(f"WITH {META} SELECT * FROM full_meta")
def path_metadata(load):
    return IN.path_metadata(_paths(load), "P")


@query(f"""WITH {META} SELECT file AS current_path, dir || '/' || correct_name || '.txt' AS correct_path
FROM full_meta WHERE name <> correct_name""")
def rename_plan(load):
    return IN.rename_plan(IN.path_metadata(_paths(load), "P"))


@query("SELECT page_id, url FROM pages WHERE regexp_matches(url, 'blog|www') AND NOT regexp_matches(url, '^https')")
def filter_regex(load):
    url = F.col("url")
    return load("pages").filter(url.rlike("blog|www") & ~url.rlike("^https")).select("page_id", "url")


@query(r"""SELECT page_id, nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS number,
  nullif(regexp_extract(url, 'page=([0-9]+)', 1), '') AS page FROM pages""")
def regex_extract_first(load):
    return load("pages").select("page_id", extract_first("url", r"(?<=/)\d+").alias("number"),
                                extract_first("url", r"(?<=page=)\d+").alias("page"))


# -- points ----------------------------------------------------------------

# Areas of two sizes: a square around the origin for each label 0..9 in a row
# of ten (edges shared), and one wide area that overlaps some of them.
STEP = 0.08
X0, Y0, Y1 = -0.4, -0.2, 0.15


def _areas(load):
    """Area table made from the labels in use: corners, codes."""
    n = F.col("label")
    lo, hi = F.lit(X0) + n * F.lit(STEP), F.lit(X0) + (n + 1) * F.lit(STEP)
    rows = load("embeddings").select("label").distinct()
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    y0, y1 = F.lit(Y0), F.lit(Y1)
    small = rows.select(
        F.concat(F.lit("2"), F.lpad(n.cast("string"), 3, "0")).alias("SA1"), F.concat(F.lit("B"), n).alias("SA2"),
        F.array(corner(lo, y0), corner(hi, y0), corner(hi, y1), corner(lo, y1)).alias("ring"))
    wide = rows.filter("label = 1").select(
        F.lit("1000").alias("SA1"), F.lit("A").alias("SA2"),
        F.array(corner(F.lit(-0.3), F.lit(-1.0)), corner(F.lit(3.0), F.lit(-1.0)), corner(F.lit(-0.3), F.lit(0.0))).alias("ring"))
    return small.unionByName(wide)


AREAS = f"""labels_used AS (SELECT DISTINCT label FROM embeddings),
boxes AS (SELECT '2' || lpad(CAST(label AS VARCHAR), 3, '0') AS sa1, 'B' || label AS sa2,
    CAST({X0} AS DOUBLE) + label * CAST({STEP} AS DOUBLE) AS lo, CAST({X0} AS DOUBLE) + (label + 1) * CAST({STEP} AS DOUBLE) AS hi FROM labels_used),
points AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
hits AS (SELECT id, sa1, sa2 FROM points JOIN boxes ON x BETWEEN lo AND hi AND y BETWEEN {Y0} AND {Y1}
  UNION ALL SELECT id, '1000', 'A' FROM points WHERE x >= -0.3 AND y >= -1.0 AND y <= 0.0 AND (x + 0.3) / 3.3 + (y + 1.0) <= 1.0),
best AS (SELECT id, min(sa1) AS sa1, arg_min(sa2, sa1) AS sa2 FROM hits GROUP BY id)"""


def _points(load):
    e = F.col("embedding")
    return load("embeddings").select(F.col("vec_id").alias("id"), e[0].cast("double").alias("x"), e[1].cast("double").alias("y"))


@query(f"WITH {AREAS} SELECT best.id, x, y, sa1 AS \"SA1\", sa2 AS \"SA2\" FROM best JOIN points USING (id)")
def point_in_area(load):
    """Lowest code of the areas that hold the point; points outside are dropped."""
    return assign_areas(_points(load), _areas(load), "id", "x", "y", "SA1", keep=["SA2"])


def _boxed(x, y, x0, x1, y0, y1):
    return f"({x} BETWEEN {x0} AND {x1} AND {y} BETWEEN {y0} AND {y1})"


@query(f"""WITH points AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
hits AS (
  SELECT id, 1000 + label AS code FROM points, (SELECT DISTINCT label FROM embeddings)
  WHERE {_boxed("x", "y", "-0.25", "0.25 - label / 128.0", "-0.25", "0.25")}
    AND NOT (x > -0.125 AND x < 0.125 - label / 128.0 AND y > -0.125 AND y < 0.125)
  UNION ALL SELECT id, 100 FROM points WHERE {_boxed("x", "y", "-0.0625", "0", "-0.0625", "0")} OR {_boxed("x", "y", "0.03125", "0.0625", "0.03125", "0.0625")}
  UNION ALL SELECT id, 5000 FROM points WHERE {_boxed("x", "y", "-64", "64", "-64", "64")})
SELECT points.id, x, y, min(code)::BIGINT AS code FROM points JOIN hits USING (id) GROUP BY ALL""")
def point_in_parts(load):
    """Areas with a hole, an area of two parts, and one that holds them all."""
    def box(x0, x1, y0, y1):
        corner = lambda a, b: F.struct(F.lit(a).cast("double").alias("x") if not hasattr(a, "cast") else a.alias("x"), F.lit(b).cast("double").alias("y"))
        return F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1))

    label = F.col("label").cast("double") / 128
    labels = load("embeddings").select("label").distinct()
    ringed = labels.select((F.col("label") + 1000).cast("bigint").alias("code"), F.array(
        box(-0.25, 0.25 - label, -0.25, 0.25), box(-0.125, 0.125 - label, -0.125, 0.125)).alias("ring"))
    two = labels.where("label = 1").select(F.lit(100).cast("bigint").alias("code"), F.array(
        box(-0.0625, 0.0, -0.0625, 0.0), box(0.03125, 0.0625, 0.03125, 0.0625)).alias("ring"))
    all_ = labels.where("label = 1").select(F.lit(5000).cast("bigint").alias("code"), F.array(box(-64, 64, -64, 64)).alias("ring"))
    return assign_areas(_points(load), ringed.unionByName(two).unionByName(all_), "id", "x", "y", "code")


@query(f"""WITH {AREAS}, national AS (SELECT n_nationkey + 2000 AS sa1, n_regionkey AS score FROM nation),
state AS (SELECT n_nationkey + 2005 AS sa1, n_regionkey * 10 AS score FROM nation)
SELECT 'P_' || id AS id, CAST(best.sa1 AS BIGINT) AS sa1, sa2, national.score AS "score.x", state.score AS "score.y"
FROM best LEFT JOIN national ON CAST(best.sa1 AS BIGINT) = national.sa1 LEFT JOIN state ON CAST(best.sa1 AS BIGINT) = state.sa1""")
def area_index_linkage(load):
    """Codes of each point, then two lookups with clashing value names."""
    located = AR.area_codes(_points(load), _areas(load), "P_", ["SA1", "SA2"], x="x", y="y")
    nation = load("nation")
    lookup = lambda by, k: nation.select((F.col("n_nationkey") + by).alias("sa1"), (F.col("n_regionkey") * k).alias("score"))
    return AR.link_indexes(located, lookup(2000, 1), lookup(2005, 10), "sa1")
