"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A run is a stretch of consecutive non-blank lines of `min_words` words or more. A run that stood before, in a document
of a lesser id or further up in the same one, is deleted line by line; its first occurrence stays. Lines are equal if
they are the same text but for spaces at their ends.

How: of the lines of every window (the fewest lines from some line on that have `min_words` words, downwards or upwards)
the one with the least hash is its fingerprint. Equal runs hold equal windows and so equal fingerprints; windows whose
fingerprint stands in one place only are dropped. The others are grouped by their whole content, not extended line by
line, and those that are equal merged where they overlap: every line of a repeated run of `min_words` words is in a
downward or an upward window that lies in the run. All equal windows are compared with their first occurrence alone, so
a passage that very many documents share costs one row per occurrence, not one per pair.

A null text stays null and has no lines; an empty one has one blank line. Blank lines are no part of a run and go with
a deleted line above them. A null id counts as the least. Rows of equal id and equal text are one document and all get
the same result; rows of equal id and different texts are told apart by the text's hash. Other columns are kept as they
are, whatever their names. Equality of lines and windows is that of 96 bits of hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, table

#: Words that a repeated run must have.
MIN_WORDS = 50
_WORD = r"[^ \t\n\x0B\f\r]+"


#: Stands for the end of a text whose number of lines is not known yet.
_END = 1 << 30


def _lines(docs: DataFrame) -> DataFrame:
    """One row per non-blank line: the document's key, place, place of the next non-blank line, words, hashes."""
    text = F.col("text").cast("string")
    split = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("th"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    # A cheap test for blank lines: Spark works a filter's expressions out twice, and counting words is dear.
    rows = split.filter(F.col("line").rlike(_WORD[:-1])).withColumn("line", F.trim("line"))
    rows = rows.select(
        "id", "th", "pos", F.regexp_count("line", F.lit(_WORD)).alias("words"), F.xxhash64("line").alias("h"), F.hash("line").alias("g")
    )
    # One exchange by document serves the removal of repeated rows and all windows.
    rows = rows.repartition("id", "th").dropDuplicates(["id", "th", "pos"])
    by_place = Window.partitionBy("id", "th").orderBy("pos")
    last = F.sum("words").over(by_place.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.select("*", F.coalesce(F.lead("pos").over(by_place), F.lit(_END)).alias("until"), last.alias("last"))
    return rows.withColumns({"first": F.col("last") - F.col("words"), "at": F.struct("h", "g", "pos")})


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """All whole windows from a line downwards and upwards: span, fingerprint and its place, a hash of all their lines."""
    place = Window.partitionBy("id", "th")
    frames = place.orderBy("first").rangeBetween(0, min_words - 1), place.orderBy("last").rangeBetween(1 - min_words, 0)
    both = [
        F.struct(
            F.min("pos").over(frame).alias("start"),
            F.max("until").over(frame).alias("stop"),
            F.sum("words").over(frame).alias("words"),
            F.collect_list("at").over(frame).alias("all"),
        )
        for frame in frames
    ]
    found = lines.select("id", "th", F.array(*both).alias("both")).select("id", "th", F.inline("both"))
    found = found.filter(F.col("words") >= min_words)
    content = F.transform("all", lambda x: F.struct(x["h"], x["g"]))
    found = found.withColumns({"least": F.array_min("all"), "content": F.xxhash64(content), "content2": F.hash(content)})
    return found.select("id", "th", "start", "stop", F.col("least.h").alias("fp"), F.col("least.pos").alias("fp_pos"), "content", "content2")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, th, spans): merged spans [start, stop) of line places to delete, by document (id and hash of the text)."""
    windows = _windows(_lines(docs), min_words)
    where = F.struct("id", "th", "fp_pos")
    repeated = windows.groupBy("fp").agg(F.min(where).alias("one"), F.max(where).alias("two")).filter("one != two")
    # Joins are by a struct, which the sums before them are not dealt by: so Spark can split a key that many rows share.
    matches = windows.withColumn("key", F.struct("fp")).join(repeated.select(F.struct("fp").alias("key")), "key", "left_semi")
    matches = settle(matches.select("id", "th", "start", "stop", "content", "content2"))
    here = F.struct("id", "th", "start")
    firsts = matches.groupBy("content", "content2").agg(F.min(here).alias("origin"), F.max(here).alias("last")).filter("origin != last")
    body = F.struct("content", "content2").alias("body")
    later = matches.select("id", "th", "start", "stop", body).join(firsts.select(body, "origin"), "body").filter(here > F.col("origin"))
    spans = later.groupBy("id", "th", "start").agg(F.max("stop").alias("stop"))
    by_start = Window.partitionBy("id", "th").orderBy("start")
    reach = F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    fresh = spans.withColumn("fresh", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
    runs = fresh.withColumn("run", F.sum("fresh").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("id", "th", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return merged.groupBy("id", "th").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def _kept(lines: Column, spans: Column) -> Column:
    """The text of `lines` without `spans`, one slice of lines between each two of them."""

    def part(i: Column) -> Column:
        begin = F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["stop"])
        end = F.when(i == F.size(spans), F.size(lines)).otherwise(F.get(spans, i)["start"])
        return F.slice(lines, begin + 1, F.greatest(end - begin, F.lit(0)))

    return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(spans)), part)), "\n")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, report: str = "line_report") -> DataFrame:
    """`docs` with the cleaned text, and a struct `report` of n_lines, n_removed and the removed spans of lines."""
    spans = repeated_spans(docs, min_words)
    text = F.col("text").cast("string")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != report])
    rows = docs.select(row.alias("row"), F.col("doc_id").alias("rid"), F.xxhash64(text).alias("rth"))
    joined = rows.join(spans, rows["rid"].eqNullSafe(spans["id"]) & (rows["rth"] == spans["th"]), "left")
    lines = F.split(F.col("row.text").cast("string"), "\n")
    joined = joined.withColumn(
        "spans", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.least(s["stop"], F.size(lines)).alias("stop")))
    )
    cleaned = F.when(F.col("spans").isNull(), F.col("row.text").cast("string")).otherwise(_kept(lines, F.col("spans")))
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["stop"] - s["start"])
    kept = [cleaned.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != report]
    return joined.select(
        *kept,
        F.struct(
            F.when(F.col("row.text").isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
            F.coalesce(removed, F.lit(0)).cast("bigint").alias("n_removed"),
            F.col("spans"),
        ).alias(report),
    )


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", "line_report.n_lines", "line_report.n_removed")


ORACLE_OP5 = r"""
WITH l AS (
  SELECT doc_id, p - 1 AS pos, len(a) AS n, a[p] AS line, len(regexp_extract_all(a[p], '[^ \t\n\x0B\f\r]+')) AS words
  FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS p
        FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL))),
s AS (
  SELECT doc_id, pos, trim(line, ' ') AS line, words, coalesce(lead(pos) OVER w, n) AS until,
    sum(words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e
  FROM l WHERE words > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
f AS (
  SELECT doc_id, min(pos) OVER w AS a, max(until) OVER w AS z, sum(words) OVER w AS n, list(line) OVER w AS body
  FROM (SELECT *, e - words AS c FROM s) WINDOW w AS (PARTITION BY doc_id ORDER BY c RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)),
g AS (
  SELECT doc_id, min(pos) OVER w AS a, max(until) OVER w AS z, sum(words) OVER w AS n, list(line) OVER w AS body
  FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY e RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
win AS (SELECT * FROM f WHERE n >= 50 UNION ALL SELECT * FROM g WHERE n >= 50),
firsts AS (SELECT body, min((doc_id, a)) AS origin FROM win GROUP BY body),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(a, z)) AS pos
  FROM win JOIN firsts USING (body) WHERE (doc_id, a) > origin),
clean AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE gone.pos IS NULL) AS text,
    count(gone.pos) AS n_removed, any_value(n) AS n_lines
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(clean.text, '') END AS text,
  coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN clean ON d.doc_id = clean.doc_id
"""
