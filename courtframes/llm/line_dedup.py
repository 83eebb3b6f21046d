"""Removal of repeated runs of lines by winnowing, in DataFrame operations alone.

A document's lines are hashed, and of each `window` neighbouring hashes the least is selected as a
fingerprint (the rightmost of equals).  Two places that share a run of at least `window` lines select the
same fingerprints inside it, so a run whose fingerprint stands once in the corpus is not repeated and
goes no further.  Places of repeated fingerprints are joined and extended to both sides: each window
of lines in which the place was selected is named by the hash of its lines, and the first place of each name,
by document id and position, is found.  A line in a window that also stands at an earlier place is
deleted; overlapping windows make up the whole repeated run.  The first copy of every run stays.

Where asked for, a line that carries content by itself, in words or characters, is a run of its own: its
later places are deleted whatever stands around them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtframes.llm.common import materialise

WINDOW = 2
#: A line of so many words, or of so many characters where words are not parted, carries content by itself.
LINE_WORDS = 5
LINE_CHARS = 40


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _places(hashes: Column, windows: Column, window: int) -> Column:
    """Selected positions with their fingerprint and the windows that selected them, at most `window`."""
    positions = F.array_distinct(F.transform(windows, lambda w: w["at"]))
    return F.transform(
        positions,
        lambda p: F.struct(
            F.get(hashes, p)["h"].alias("print"),
            F.filter(F.slice(windows, F.greatest(p - (window - 1), F.lit(0)) + 1, F.lit(window)), lambda w: (w["at"] == p) & w["filled"]).alias("windows"),
        ),
    )


def repeated_windows(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, version, start) of each window of lines that also stands at an earlier place.

    version is the hash of the text, so rows of one id with other texts are told apart.
    """
    text = F.col(text_col)
    # empty lines hash to zero; a window of nothing else is no run
    hashes = F.transform(_lines(text), lambda line, i: F.struct(F.when(line == "", F.lit(0)).otherwise(F.xxhash64(line)).alias("h"), (-i).alias("back")))
    rows = docs.filter(text.isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), hashes.alias("hashes"))
    rows = rows.filter(F.size("hashes") >= window)
    windows = F.transform(
        F.sequence(F.lit(0), F.size("hashes") - window),
        lambda s: F.struct(
            s.alias("start"),
            (-F.array_min(F.slice("hashes", s + 1, F.lit(window)))["back"]).alias("at"),
            F.xxhash64(F.transform(F.slice("hashes", s + 1, F.lit(window)), lambda x: x["h"])).alias("name"),
            F.exists(F.slice("hashes", s + 1, F.lit(window)), lambda x: x["h"] != 0).alias("filled"),
        ),
    )
    rows = rows.withColumn("windows", windows)
    places = rows.select("id", "version", F.explode(_places(F.col("hashes"), F.col("windows"), window)).alias("p"))
    places = places.select("id", "version", "p.print", F.transform("p.windows", lambda w: F.struct(w["start"].alias("start"), w["name"].alias("name"))).alias("windows"))
    places = materialise(places.filter(F.size("windows") > 0), "places")
    again = materialise(places.groupBy("print").agg(F.count("*").alias("n")).filter("n > 1").select("print"), "prints")
    found = places.join(again, "print", "left_semi").select("id", "version", F.explode("windows").alias("w")).select("id", "version", "w.start", "w.name")
    found = materialise(found, "windows")
    place = F.struct("id", "version", "start")
    first = found.groupBy("name").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last").select("name", "first")
    # stored, so that the join's sides are plain shuffles, whose skewed parts adaptive execution splits
    return found.join(materialise(first, "firsts"), "name").filter(place != F.col("first")).select("id", "version", "start")


def repeated_lines(docs: DataFrame, line_words: int = LINE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, version, start) of each line of at least line_words words or LINE_CHARS characters that also stands
    at an earlier place, as repeated_windows."""
    text = F.col(text_col)
    rows = docs.filter(text.isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), F.posexplode(_lines(text)).alias("start", "line"))
    full = (F.length(F.trim("line")) >= LINE_CHARS) | (F.regexp_count("line", F.lit(r"[^ \t-\r]+")) >= line_words)
    found = materialise(rows.filter(full).select("id", "version", "start", F.xxhash64("line").alias("name")), "lines")
    place = F.struct("id", "version", "start")
    first = found.groupBy("name").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last").select("name", "first")
    # stored, so that the join's sides are plain shuffles, whose skewed parts adaptive execution splits
    return found.join(materialise(first, "firsts"), "name").filter(place != F.col("first")).select("id", "version", "start")


def dedup_lines(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", line_words: int | None = None) -> DataFrame:
    """docs with repeated runs of at least `window` lines taken out of the text, and n_lines, n_removed.

    Lines end at line feeds and are compared exactly.  Null texts stay null with no lines; a text whose
    lines all go becomes empty; texts of fewer lines than `window` stay.  Repeated rows of one id and text
    are one place, so they stay alike.  Runs that repeat inside one text are repeated too.  Columns of
    docs named n_lines or n_removed are replaced; an empty table gives no rows.  With line_words, repeated
    lines of so many words or of LINE_CHARS characters go too, between unique lines and in texts of one line.
    """
    extra = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    runs = repeated_windows(docs, window, id_col, text_col).withColumn("lines", F.lit(window))
    if line_words is not None:
        runs = runs.unionByName(repeated_lines(docs, line_words, id_col, text_col).withColumn("lines", F.lit(1)))
    gone = runs.groupBy("id", "version").agg(F.collect_set(F.struct("start", "lines")).alias("runs"))
    positions = F.flatten(F.transform("runs", lambda r: F.sequence(r["start"], r["start"] + (r["lines"] - 1))))
    gone = gone.select("id", "version", positions.alias("gone"))
    text = F.col(f"d.`{text_col}`")
    joined = docs.alias("d").join(gone.alias("g"), (F.col(f"d.`{id_col}`") == F.col("g.id")) & (F.xxhash64(text) == F.col("g.version")), "left")
    lines = _lines(text)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("g.gone"))
    after = F.when(F.col("g.gone").isNull(), text).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    n_lines = F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_removed = F.when(F.col("g.gone").isNull(), 0).otherwise(F.size(F.array_distinct("g.gone"))).cast("long")
    columns = [after.alias(c) if c == text_col else F.col(f"d.`{c}`") for c in extra]
    return joined.select(*columns, n_lines.alias("n_lines"), n_removed.alias("n_removed"))


def oracle(window: int = WINDOW, line_words: int | None = LINE_WORDS) -> str:
    """DuckDB SQL of doc_id, text, n_lines and n_removed over documents."""
    single = f"""
    singles as (select doc_id, s, line from (select doc_id, ls, unnest(range(0, len(ls))) as s, unnest(ls) as line from l)
                where length(trim(line)) >= {LINE_CHARS} or len(regexp_extract_all(line, '[^ \\t-\\r]+')) >= {line_words}),
    again as (select doc_id, s from (select *, row_number() over (partition by line order by doc_id, s) as k from singles) where k > 1),"""
    also = " union all select doc_id, s as p from again"
    return f"""
    with l as (select doc_id, text, string_split(text, chr(10)) as ls from documents),
    w as (select doc_id, s, ls[s + 1:s + {window}] as run
          from (select doc_id, ls, unnest(range(0, len(ls) - {window} + 1)) as s from l where len(ls) >= {window})),
    later as (select doc_id, s from (select *, row_number() over (partition by run order by doc_id, s) as k from w
              where len(list_filter(run, lambda x: x <> '')) > 0) where k > 1),{single if line_words is not None else ""}
    places as (select doc_id, unnest(range(s, s + {window})) as p from later{also if line_words is not None else ""}),
    gone as (select doc_id, list(distinct p) as ps from places group by doc_id)
    select l.doc_id,
           case when ps is null then text
                else array_to_string(list_filter(ls, lambda x, i: not list_contains(ps, i - 1)), chr(10)) end as text,
           cast(coalesce(len(ls), 0) as bigint) as n_lines, cast(coalesce(len(ps), 0) as bigint) as n_removed
    from l left join gone on l.doc_id = gone.doc_id"""
