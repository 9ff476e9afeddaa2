"""Benchmark decontamination by template windows; DataFrame functions only.

A text becomes rows of tokens in which numbers, units after a number, and
capitalised words within a sentence are typed placeholders.  Documents are
joined with the benchmark on hashes of eight tokens in a row.  What matches on
one diagonal is then checked slot by slot: a re-parameterised question puts the
same new value wherever the item has the same old one, and the other way round.

There are up to three rows of tokens, alike but for names: as they are marked
within sentences; with sentence openers as names too where the same word is
marked elsewhere; and with names as plain small words, for copies in other
letter case.  Items too short or too bare for windows are matched word by word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longitab.session import stage

from .common import with_ids

#: Tokens of a window (the doublings below need a power of two), and how many of them must be words.
WINDOW, LITERALS = 8, 4
#: Tokens of the pieces of items that are matched as they stand.
WIDTHS = (1, 2, 4, 8)
#: A match counts from this many tokens in a row, or from this share of the item's windows.
TOKENS, COVERAGE = 13, 0.5
#: Windows of the benchmark that may be sent to every executor: about 40 MB.  Above, documents are shuffled.
BROADCAST_WINDOWS = 1_000_000
NAME, NUMBER, UNIT, OPENER = "\u0001", "\u0002", "\u0003", "\u0004"
#: Units of measure, as they stand after a number.
UNITS = (
    "mm cm m km in inch inches ft feet foot yd yards mi mile miles mg g kg t lb lbs pounds oz ml cl l liter liters litre litres "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "percent degrees c f k hz khz mhz ghz w kw mw v kv a j kj cal kcal usd eur gbp dollar dollars euro euros cent cents "
    "kb mb gb tb mph kmh"
).split()
#: The rows of tokens of a text.
FAMILIES = ("named", "opened", "folded")
WORDS = r"[\p{L}\p{M}]+"
NUMBERS = r"[0-9]+(?:[.,][0-9]+)*"


def _marked(text: Column) -> Column:
    """Small letters, with marks before names (a capital and then a small letter, after a word or comma of the
    same sentence and white space) and before what else is written like one."""
    plain = F.translate(F.coalesce(text, F.lit("")), NAME + NUMBER + UNIT + OPENER, " " * 4)
    named = F.regexp_replace(plain, r"[\p{L}\p{N},;:][\s\p{Z}]+(?=\p{Lu}\p{Ll})", "$0" + NAME)
    return F.lower(F.regexp_replace(named, rf"(?<![\p{{L}}\p{{M}}\p{{N}}{NAME}])\p{{Lu}}(?=\p{{Ll}})", OPENER + "$0"))


def _opened(marked: Column) -> Column:
    """The same with openers marked as names where the same word is a name elsewhere in the text; null where there are none."""
    words = lambda mark: F.regexp_extract_all(marked, F.lit(f"{mark}({WORDS})"), F.lit(1))
    both = F.array_join(F.array_intersect(words(NAME), words(OPENER)), "|")
    pattern = F.concat(F.lit(f"{OPENER}(?=(?:"), both, F.lit(r")(?![\p{L}\p{M}]))"))
    return F.when(marked.contains(NAME) & (both != ""), F.regexp_replace(marked, pattern, F.lit(NAME)))


def tokens(text: Column) -> Column:
    """The words and numbers as they stand, in small letters."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"{WORDS}|{NUMBERS}"), F.lit(0))


def _template(marked: Column, names: bool = True) -> Column:
    """The tokens with placeholders in place of slots, position by position; one empty token where there are none."""
    t = F.regexp_replace(marked, NUMBERS, f" {NUMBER} ")
    t = F.regexp_replace(t, f"{NAME}{WORDS}", NAME) if names else F.translate(t, NAME, "")
    t = F.regexp_replace(t, rf"(?<={NUMBER} )[\s\p{{Z}}]*{OPENER}?(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{M}}])", UNIT)
    return F.split(F.trim(F.regexp_replace(F.translate(t, OPENER, ""), rf"[^\p{{L}}\p{{M}}{NAME}-{UNIT}]+", " ")), " ")


def templates(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """The other columns and ``FAMILIES``: names marked, openers too, names as plain words; the last two null if like the first."""
    others = [c for c in rows.columns if c != text_col]
    rows = rows.select(*others, _marked(F.col(text_col)).alias("_m"))
    rows = rows.select(*others, "_m", _opened(F.col("_m")).alias("_o"))
    made = (_template(F.col("_m")), F.when(F.col("_o").isNotNull(), _template(F.col("_o"))),
            F.when(F.col("_m").contains(NAME), _template(F.col("_m"), False)))
    return rows.select(*others, *[t.alias(c) for t, c in zip(made, FAMILIES)])


def windows(rows: DataFrame, columns: tuple[str, ...], width: int = WINDOW) -> DataFrame:
    """One row per window of ``width`` tokens: the other columns, ``pos`` and ``hash``.

    The hash of 2, 4, 8 tokens comes from two of half the length, so a window
    costs three steps and no string is built.  Short rows are not filtered out
    but give no windows: a filter moves below the template and makes it twice.
    Of ``columns`` after the first, only windows that differ from it have a hash.
    """
    others = [c for c in rows.columns if c not in columns]
    rows = rows.withColumn("_n", F.size(columns[0]))
    rows = rows.select(*others, "_n", *[F.transform(c, lambda w: F.xxhash64(w)).alias(c) for c in columns])
    done = 1
    while done < width:
        ahead = {c: F.slice(c, F.lit(1 + done), F.col("_n")) for c in columns}
        rows = rows.withColumns({c: F.zip_with(c, ahead[c], lambda a, b: F.xxhash64(a, b)) for c in columns})
        done *= 2
    rows = rows.withColumn("_n", F.greatest(F.col("_n") - (width - 1), F.lit(0)))
    rows = rows.withColumns({c: F.slice(c, F.lit(1), F.col("_n")) for c in columns})
    first = F.col(columns[0])
    differ = [F.coalesce(F.zip_with(first, c, lambda a, b: F.when(a != b, b)), F.array().cast("array<bigint>")) for c in columns[1:]]
    made = rows.select(*others, "_n", F.posexplode(F.concat(first, *differ)).alias("pos", "hash"))
    return made.select(*others, (F.col("pos") % F.col("_n")).alias("pos"), "hash")


def _is_slot(token: Column) -> Column:
    return token.isin(NAME, NUMBER, UNIT)


def benchmark_windows(items: DataFrame) -> DataFrame:
    """``(item, version, at, hash, typed)`` of the windows of each of ``FAMILIES`` that hold enough words;
    ``typed`` where they do so without names."""
    found = []
    for family in FAMILIES:
        words = F.transform(family, lambda w: F.when(_is_slot(w), 0).otherwise(1))
        rich = F.aggregate(F.slice("literal", F.col("pos") + 1, WINDOW), F.lit(0), lambda s, x: s + x) >= LITERALS
        rows = items.where(F.col(family).isNotNull()).select("item", "version", words.alias("literal"), family)
        found.append(windows(rows, (family,)).where(rich).select("item", "version", F.col("pos").alias("at"), "hash", F.lit(family != "folded").alias("typed")))
    keys = found[0].unionByName(found[1]).unionByName(found[2])
    typed = keys.groupBy("item", "version", "at").agg(F.max("typed").alias("typed"))
    return keys.drop("typed").distinct().join(typed, ["item", "version", "at"])


def exact_pieces(items: DataFrame) -> DataFrame:
    """``(item, version, at, hash, width)``: pieces of 1, 2, 4 or 8 tokens as they stand that together are the whole item."""
    n = F.size("values")
    rows = items.where(n > 0).select("item", "version", "values", n.alias("n"))
    found = []
    for width in WIDTHS:
        some = rows.where((F.col("n") >= width) & ((F.col("n") < 2 * width) | F.lit(width == WINDOW)))
        needed = (F.col("pos") % width == 0) | (F.col("pos") == F.col("n") - width)
        found.append(windows(some, ("values",), width).where(needed).select("item", "version", F.col("pos").alias("at"), "hash", F.lit(width).alias("width")))
    return reduce(DataFrame.unionByName, found)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least_tokens: int = 1,
) -> DataFrame:
    """Documents that hold a benchmark item or a re-parameterised form of it.

    Returns ``(<id>, <item>, position, windows, item_windows, slots)``, one row
    per document and item, of their best diagonal: the token of the document at
    which the item starts (negative if its start is missing), how many of the
    item's windows count, and how many slots these hold.  A window counts if
    its tokens match and its slots agree with the rest of the diagonal: the
    value is the item's own, or most slots of the diagonal that have its old
    value, and most that have its new one, have both.  A pair counts if such
    windows hold ``TOKENS`` tokens or are ``COVERAGE`` of the item's.

    Letter case, punctuation and white space do not count in a copy; a form
    with other names needs them capitalised.  An item of fewer than eight
    tokens, or without a window of four words, has to stand in the document
    word by word, however short it is; its windows are then the pieces it is
    matched by.  Items of fewer than ``least_tokens`` tokens match nothing: a
    word like "yes" as an item is said by every other document.  Rows of one item that differ are forms of it, each on its own.
    Null texts hold no tokens; rows without an id are not reported; rows of one
    id are one document.  Other columns are ignored; an empty table on either
    side gives no rows.
    """
    rows = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text")).where("doc is not null")
    forms = benchmark.select(benchmark[item_col].alias("item"), benchmark[item_text_col].alias("text")).where("item is not null").distinct()
    made = templates(forms.withColumn("values", tokens(F.col("text")))).where(F.size("values") >= least_tokens)
    items = stage(made.withColumn("version", F.xxhash64("values", *FAMILIES)).dropDuplicates(["item", "version"]))
    keys = stage(benchmark_windows(items))
    bare = items.join(keys.select("item", "version").distinct(), ["item", "version"], "left_anti")
    pieces = stage(exact_pieces(bare))
    totals = stage(
        keys.groupBy("item", "version").agg(F.countDistinct("at").alias("item_windows"),
                                            F.countDistinct(F.when(F.col("typed"), F.col("at"))).alias("typed_windows"), F.lit(False).alias("exact"))
        .unionByName(pieces.groupBy("item", "version").agg(F.count("*").alias("item_windows"), F.lit(0).cast("long").alias("typed_windows"), F.lit(True).alias("exact"))))

    def meet(found: DataFrame, wanted: DataFrame) -> DataFrame:
        wanted = wanted.select("item", "version", "hash", "at", "typed")
        return found.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_WINDOWS else wanted, "hash")

    found = meet(windows(templates(rows), FAMILIES), keys)
    for (width,) in pieces.select("width").distinct().collect():  # one of WIDTHS
        as_said = windows(rows.select("doc", tokens(F.col("text")).alias("said")), ("said",), width)
        found = found.unionByName(meet(as_said, pieces.where(F.col("width") == width).withColumn("typed", F.lit(False))))
    typed = F.size(F.filter("ats", lambda a: a["typed"]))
    counts = F.when(F.col("exact"), F.size("ats") == F.col("item_windows")).otherwise(
        (F.size("ats") >= TOKENS - WINDOW + 1) | (F.size("ats") >= COVERAGE * F.col("item_windows"))
        | ((typed > 0) & (typed >= COVERAGE * F.col("typed_windows"))))
    diagonals = stage(
        found.groupBy("doc", "item", "version", (F.col("pos") - F.col("at")).alias("position"))
        .agg(F.collect_set(F.struct("at", "typed")).alias("ats")).join(totals, ["item", "version"]).where(counts))

    row = F.coalesce("opened", "named")
    slots = F.filter(
        F.transform(row, lambda w, i: F.struct(i.alias("at"), _is_slot(w).alias("slot"), F.get("values", i).alias("value"))),
        lambda s: s["slot"])
    hit = stage(diagonals.select("doc").distinct())
    said = with_ids(rows, "doc", hit).select("doc", tokens(F.col("text")).alias("said"))
    within = lambda s, a: (s >= a["at"]) & (s < a["at"] + WINDOW)
    covered = lambda: F.filter("slots", lambda s: F.exists("ats", lambda a: within(s["at"], a)))
    lined = (
        diagonals.join(items.select("item", "version", slots.alias("slots")), ["item", "version"]).join(said, "doc")
        .withColumn("slots", covered())
        .withColumn("met", F.transform("slots", lambda s: F.struct(s["at"].alias("at"), s["value"].alias("old"), F.get("said", s["at"] + F.col("position")).alias("new"))))
        .drop("said")
    )
    of = lambda test: F.size(F.filter("met", test))
    most = lambda m: 2 * of(lambda x: (x["old"] == m["old"]) & (x["new"] == m["new"])) > F.greatest(
        of(lambda x: x["old"] == m["old"]), of(lambda x: x["new"] == m["new"]))
    both = F.size(F.array_distinct(F.transform("met", lambda m: F.struct(m["old"], m["new"]))))
    alike = (both == F.size(F.array_distinct("met.old"))) & (both == F.size(F.array_distinct("met.new")))
    # only what is neither the item's own value nor on a wholly consistent diagonal is counted through
    odd = F.when(alike, F.array().cast("array<int>")).otherwise(
        F.transform(F.filter("met", lambda m: (m["old"] != m["new"]) & ~most(m)), lambda m: m["at"]))
    fit = (
        lined.withColumn("odd", odd)
        .withColumn("ats", F.filter("ats", lambda a: ~F.exists("odd", lambda s: within(s, a)))).where(counts)
        .withColumn("slots", F.size(covered())).withColumn("windows", F.size("ats"))
    )
    best = F.max_by(F.struct("position", F.col("windows").cast("long").alias("windows"), "item_windows", "slots"),
                    F.struct("windows", -F.col("position"), "version"))
    return fit.groupBy("doc", "item").agg(best.alias("b")).select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "b.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", least_tokens: int = 1) -> DataFrame:
    """The documents without those that ``leaks`` reports, all columns kept."""
    gone = stage(leaks(docs, benchmark, id_col, text_col, item_col, item_text_col, least_tokens).select(id_col).distinct())
    return with_ids(docs, id_col, gone, "left_anti")
