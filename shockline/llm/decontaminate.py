"""Benchmark decontamination by template canonicalisation (operator 8), in DataFrame functions only.

Numbers, units after a number, and names become typed placeholders, other words lower case; punctuation
goes. Names are runs of capitalised words within a sentence, and words at the begin of a sentence that the
text also has in such a run. Windows of five template words are hash-joined with those of the benchmark, so a
question is found although its numbers or names were exchanged. Its slots must then be consistent: along an
alignment, equal values of the item stand for equal values in the document, or four fifths of them are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_input, table, written

WINDOW, CONTAINMENT = 5, 0.8
#: A broadcast beyond these row counts doesn't happen; the join then shuffles. Rows hold three numbers at most, so
#: these are 5 MB; an item's windows are counted, its texts are never broadcast.
BROADCAST_WINDOWS, BROADCAST_DOCS = 200_000, 200_000
MARK = ""
# Unit words, singular, plural and short.
UNITS = """mm cm m km inch inches foot feet ft yard yards mile miles meter meters metre metres g kg mg gram grams kilogram kilograms
lb lbs pound pounds ounce ounces oz ton tons tonne tonnes l ml liter liters litre litres gallon gallons s sec second seconds min minute minutes
h hour hours day days week weeks month months year years mph kmh percent dollar dollars euro euros cent cents usd eur degree degrees
celsius fahrenheit kelvin watt watts kw volt volts amp amps hz khz mhz ghz byte bytes kb mb gb tb""".split()
_RUN = r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*"
NAMES, TOKENS = rf"(\p{{Ll}}[,;:]? )({_RUN})", rf"{MARK}{_RUN}|[0-9]+(?:[.,:/][0-9]+)*|[\p{{L}}\p{{M}}]+"


def possessive(pattern: str) -> str:
    """The same matches without a way back: Java keeps a stack frame for each repetition that it could undo, and
    overflows on long runs. None of these runs has to give anything back, as its parts begin differently."""
    return pattern.replace(")*", ")*+").replace("]+", "]++").replace("\\p{Ll}+", "\\p{Ll}++")


def raw_tokens(text: Column) -> Column:
    """The words, numbers and marked runs of names within sentences."""
    marked = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), MARK, " "), possessive(NAMES), f"$1{MARK}$2")
    return F.regexp_extract_all(marked, F.lit(possessive(TOKENS)), F.lit(0))


def known_names(raw: Column) -> Column:
    """The words of all marked runs of a text."""
    return F.array_distinct(F.split(F.translate(F.array_join(F.filter(raw, lambda t: t.startswith(MARK)), " "), MARK, ""), " "))


def tokens(rows: DataFrame, key: str) -> DataFrame:
    """key, raw (words, numbers and marked names) and words (the template) of each text."""
    raw = rows.select(key, raw_tokens(F.col("text")).alias("raw")).withColumn("names", known_names(F.col("raw")))
    again = F.transform("raw", lambda t: F.when(F.array_contains("names", t), F.concat(F.lit(MARK), t)).otherwise(t))
    raw = raw.select(key, F.when(F.get("names", F.lit(0)) == "", F.col("raw")).otherwise(again).alias("raw"))
    return raw.withColumn("words", template(F.col("raw")))


def template(raw: Column) -> Column:
    def word(t: Column, i: Column) -> Column:
        after_number = (i > 0) & F.get(raw, i - 1).between("0", "9~")
        return (
            F.when(t.startswith(MARK), "<name>").when(t.between("0", "9~"), "<num>").when(F.lower(t).isin(UNITS) & after_number, "<unit>").otherwise(F.lower(t))
        )

    return F.transform(raw, word)


def window_hashes(words: Column, width: int) -> Column:
    """A hash for each window; a shorter text is one window, one without words has none."""
    several = F.transform(F.sequence(F.lit(1), F.size(words) - width + 1), lambda i: F.xxhash64(F.slice(words, i, width)))
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).when(F.size(words) < width, F.array(F.xxhash64(words))).otherwise(several)


def windows(rows: DataFrame, key: str, width: int) -> DataFrame:
    """(key, pos, window) for all windows of the rows' texts."""
    return tokens(rows, key).select(key, F.posexplode(window_hashes(F.col("words"), width)).alias("pos", "window"))


def sized(df: DataFrame, most: int) -> DataFrame:
    """Marked for broadcast if it has at most so many rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, item_id, matched, windows, slots: documents that hold at least `containment` of an item's
    distinct template windows with consistent slots; slots is the number of the item's distinct slot values.

    Rows with a null id and null, empty or wordless texts take no part. Repeated ids are one document
    or item with all their rows' windows. Texts shorter than a window match only texts of the same
    template. Texts of any length are read whole. Of alignments that cover equally many slots the first
    decides. Further columns are ignored; empty tables give an empty result.
    """
    docs = as_input(docs, {"doc_id": "long", "text": "string"}).where("doc_id is not null")
    items = as_input(benchmark, {"item_id": "long", "text": "string"}).where("item_id is not null")
    own = written(windows(items, "item_id", width).withColumnRenamed("pos", "item_pos"), "benchmark_windows")
    distinct = own.select("item_id", "window").distinct()
    total = distinct.groupBy("item_id").agg(F.count("*").alias("windows"))
    hits = windows(docs, "doc_id", width).join(sized(distinct, BROADCAST_WINDOWS), "window").select("doc_id", "item_id", "window")
    found = hits.distinct().groupBy("doc_id", "item_id").agg(F.count("*").alias("matched")).join(total, "item_id")
    found = written(found.where(F.col("matched") >= containment * F.col("windows")), "benchmark_found")

    # slots of the documents and items found, by their places
    def slots(rows: DataFrame, key: str, pos: str, value: str) -> DataFrame:
        raw = tokens(rows, key)
        at = F.filter(F.transform("words", lambda w, i: F.struct(i.alias(pos), w.alias("kind"), F.get("raw", i).alias(value))), lambda x: x["kind"].isin("<name>", "<num>", "<unit>"))
        return raw.select(key, F.explode(at).alias("x")).select(key, f"x.{pos}", "x.kind", f"x.{value}")

    ids = found.select("doc_id").distinct()
    leaky = docs.join(sized(ids, BROADCAST_DOCS), "doc_id", "left_semi")
    of_items = slots(items, "item_id", "p", "value")
    n_slots = of_items.groupBy("item_id").agg(F.countDistinct("value").alias("slots"))
    slotted = found.join(n_slots, "item_id", "left_semi").select("doc_id", "item_id")
    placed = own.join(n_slots, "item_id", "left_semi")
    aligned = windows(leaky, "doc_id", width).join(sized(placed, BROADCAST_WINDOWS), "window").select("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"), "item_pos")
    aligned = aligned.join(slotted, ["doc_id", "item_id"]).select("doc_id", "item_id", "shift", F.explode(F.sequence("item_pos", F.col("item_pos") + width - 1)).alias("p")).distinct()
    both = aligned.join(of_items, ["item_id", "p"]).withColumn("q", F.col("p") + F.col("shift"))
    both = both.join(slots(leaky, "doc_id", "q", "instead"), ["doc_id", "q", "kind"])
    # the alignment that covers most slots decides; among equals the first
    same = F.sum((F.col("value") == F.col("instead")).cast("long"))
    one = both.groupBy("doc_id", "item_id", "shift", "value").agg(F.count("*").alias("n"), F.countDistinct("instead").alias("values"), same.alias("same"))
    one = one.groupBy("doc_id", "item_id", "shift").agg(F.sum("n").alias("n"), F.max("values").alias("values"), F.sum("same").alias("same"))
    best = one.groupBy("doc_id", "item_id").agg(F.min_by(F.struct("values", "same", "n"), F.struct(-F.col("n"), "shift")).alias("best"))
    consistent = (F.coalesce("best.values", F.lit(1)) == 1) | (F.col("best.same") >= containment * F.col("best.n"))
    out = found.join(best, ["doc_id", "item_id"], "left").where(consistent).join(n_slots, "item_id", "left")
    return out.select("doc_id", "item_id", "matched", "windows", F.coalesce("slots", F.lit(0)).cast("long").alias("slots"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs whose id is in none of the pairs found; columns as they are, whatever their names.

    Rows without an id stay, and so do null and empty texts, unless another row of the id is found. Without
    benchmark items all rows stay.
    """
    gone = contaminated(docs, benchmark).select(F.struct("doc_id").alias("_gone")).distinct()
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    kept = own.join(gone, F.col("row.doc_id").cast("long") == F.col("_gone.doc_id"), "left_anti")
    return kept.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_UNIT_LIST = ", ".join(f"'{u}'" for u in UNITS)
_TEMPLATE = f"""
  WITH r AS (SELECT id, regexp_extract_all(regexp_replace(replace(coalesce(text, ''), '{MARK}', ' '), '{NAMES}', '\\1{MARK}\\2', 'g'), '{TOKENS}') AS raw FROM %s),
  n AS (SELECT id, raw, string_split(replace(array_to_string([t FOR t IN raw IF starts_with(t, '{MARK}')], ' '), '{MARK}', ''), ' ') AS names FROM r),
  m AS (SELECT id, [CASE WHEN t <> '' AND list_contains(names, t) THEN '{MARK}' || t ELSE t END FOR t IN raw] AS raw FROM n)
  SELECT id, raw, [CASE WHEN starts_with(raw[i], '{MARK}') THEN '<name>' WHEN raw[i] >= '0' AND raw[i] <= '9~' THEN '<num>'
                   WHEN lower(raw[i]) IN ({_UNIT_LIST}) AND i > 1 AND raw[i - 1] >= '0' AND raw[i - 1] <= '9~' THEN '<unit>' ELSE lower(raw[i]) END
                   FOR i IN range(1, len(raw) + 1)] AS words
  FROM m
"""
_WINDOWS = f"""
  SELECT id, pos, CASE WHEN len(words) < {WINDOW} THEN array_to_string(words, ' ') ELSE array_to_string(words[pos + 1 : pos + {WINDOW}], ' ') END AS win
  FROM (SELECT id, words, unnest(range(0, greatest(len(words) - {WINDOW - 1}, 1))) AS pos FROM %s WHERE len(words) > 0)
"""
_SLOTS = """
  SELECT id, p - 1 AS p, words[p] AS kind, raw[p] AS val
  FROM (SELECT id, raw, words, unnest(range(1, len(words) + 1)) AS p FROM %s) WHERE words[p] IN ('<name>', '<num>', '<unit>')
"""
ORACLE = f"""
WITH d0 AS (SELECT doc_id AS id, text FROM documents WHERE doc_id IS NOT NULL),
b0 AS (SELECT item_id AS id, text FROM benchmark WHERE item_id IS NOT NULL),
d AS ({_TEMPLATE % "d0"}), b AS ({_TEMPLATE % "b0"}), dw AS ({_WINDOWS % "d"}), bw AS ({_WINDOWS % "b"}),
tot AS (SELECT id, count(DISTINCT win) AS windows FROM bw GROUP BY id),
found AS (
  SELECT f.doc_id, f.item_id, f.matched, tot.windows FROM (
    SELECT dw.id AS doc_id, bw.id AS item_id, count(DISTINCT dw.win) AS matched FROM dw JOIN bw ON dw.win = bw.win GROUP BY 1, 2
  ) f JOIN tot ON tot.id = f.item_id WHERE matched >= {CONTAINMENT} * windows
),
ds AS ({_SLOTS % "d"}), bs AS ({_SLOTS % "b"}),
aligned AS (
  SELECT DISTINCT dw.id AS doc_id, bw.id AS item_id, dw.pos - bw.pos AS shift, unnest(range(bw.pos, bw.pos + {WINDOW})) AS p
  FROM dw JOIN bw ON dw.win = bw.win JOIN found f ON f.doc_id = dw.id AND f.item_id = bw.id
),
one AS (
  SELECT a.doc_id, a.item_id, a.shift, bs.val, count(*) AS n, count(DISTINCT ds.val) AS vals, count(*) FILTER (ds.val = bs.val) AS same
  FROM aligned a JOIN bs ON bs.id = a.item_id AND bs.p = a.p JOIN ds ON ds.id = a.doc_id AND ds.p = a.p + a.shift AND ds.kind = bs.kind
  GROUP BY ALL
),
ranked AS (
  SELECT doc_id, item_id, max(vals) AS vals, sum(same) AS same, sum(n) AS n, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY sum(n) DESC, shift) AS r FROM one GROUP BY doc_id, item_id, shift
),
ns AS (SELECT id, count(DISTINCT val) AS slots FROM bs GROUP BY id)
SELECT f.doc_id, f.item_id, f.matched, f.windows, CAST(coalesce(ns.slots, 0) AS BIGINT) AS slots
FROM found f LEFT JOIN ranked r ON r.doc_id = f.doc_id AND r.item_id = f.item_id AND r.r = 1 LEFT JOIN ns ON ns.id = f.item_id
WHERE coalesce(r.vals, 1) = 1 OR r.same >= {CONTAINMENT} * r.n
"""
