"""Benchmark decontamination over a positional inverted index, in DataFrame operations only.

The postings of all words that any benchmark item has are stored once: document, place, word. Word
counts over the whole corpus choose, for each window of an item, its rarest words; shifted by their
place in the item, their postings name a diagonal (document, item, shift), and the lists of one
diagonal are intersected. What is left is compared word by word, one row a diagonal, and runs of places
that agree are the exact phrases. Words are represented by 64-bit hashes up to that comparison, which settles any collision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runweave.llm.common import content_key, fresh, small, small_in_bytes, stored

# --- fixed values: what a word is, and which letters fold ----------------------
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# -------------------------------------------------------------------------------

#: Rarest words of a window whose postings have to meet.
RAREST = 2


def words(text: str | Column = "text") -> Column:
    """Words of a text, A-Z as a-z; a null text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), 1)


def item_table(benchmark: DataFrame, width: int) -> DataFrame:
    """Distinct items with words: ``(item, item_id, words, k)``, ``k`` the length of their windows."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words().alias("words"))
    rows = rows.where(F.size("words") > 0).distinct()
    named = F.concat_ws(" ", F.coalesce("item_id", F.lit("-")), F.lit("/"), F.array_join("words", " "))
    rows = rows.withColumn("item", F.unhex(F.md5(named.cast("binary"))))
    return stored(rows.withColumn("k", F.least(F.size("words"), F.lit(width))), "items")


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings ``(key, doc_id, n_words, term, pos)`` of the words in ``terms``, and one of term 0 a document.

    ``key`` stands for the text, so that a null or repeated id does no harm. Places count from 1; the
    posting of term 0, at place 0, is the document itself and alone has ``doc_id`` and ``n_words``. Stored as each task made it: no shuffle.
    """
    each = docs.select(
        content_key().alias("key"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.concat(F.array(F.lit("")), words()).alias("words"),
    )
    each = each.select("key", "doc_id", (F.size("words") - 1).alias("n_words"), "words")
    rows = each.select("key", "doc_id", "n_words", F.posexplode("words").alias("pos", "word"))
    rows = rows.withColumn("term", _term(F.col("word")))
    of_document = [F.when(F.col("term") == 0, F.col(c)).alias(c) for c in ("doc_id", "n_words")]
    wanted = small(terms.union(terms.sparkSession.sql("select 0L as term")).distinct())
    return stored(
        rows.join(wanted, "term").select("key", *of_document, "term", "pos"), "postings"
    )


def _term(word: Column) -> Column:
    return F.when(word == "", F.lit(0).cast("bigint")).otherwise(F.xxhash64(word))


def anchors(items: DataFrame, index: DataFrame) -> DataFrame:
    """``(term, item, at, need)``: places in items that hold the rarest words of some window.

    Every window of an item has ``need`` of these places at least.
    """
    counts = stored(
        index.where("term <> 0").groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term-counts"
    )
    places = items.select("item", "k", F.size("words").alias("size"), F.posexplode("words").alias("at", "word"))
    places = places.withColumn("term", _term(F.col("word"))).join(counts, "term", "left")
    first = F.greatest(F.lit(0), F.col("at") - F.col("k") + 1)
    windows = places.withColumn("start", F.explode(F.sequence(first, F.least("at", F.col("size") - F.col("k")))))
    rare = Window.partitionBy("item", "start").orderBy(F.coalesce("n", F.lit(0)), "at")
    chosen = windows.withColumn("r", F.row_number().over(rare)).where(F.col("r") <= RAREST)
    need = F.least(F.lit(RAREST), F.col("k"))
    return stored(chosen.select("term", "item", "at", need.alias("need")).distinct(), "anchors")


def diagonals(index: DataFrame, chosen: DataFrame) -> DataFrame:
    """``(key, item, shift)`` where postings of ``need`` chosen places meet: word i of the item would
    stand at place ``shift + i``, places counted from 0."""
    hits = index.where("term <> 0").join(small(chosen), "term")
    hits = hits.select("key", "item", "need", "at", (F.col("pos") - 1 - F.col("at")).alias("shift"))
    met = hits.groupBy("key", "item", "shift").agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.min("need").alias("need")
    )
    return met.where("low < high or need = 1").select("key", "item", "shift")


def proximity(index: DataFrame, chosen: DataFrame, slack: int) -> DataFrame:
    """``(key, item)``: two chosen rare words of an item stand within ``slack`` places of their distance in it.

    Two postings of different places of the item meet if their shifts differ by ``slack`` at most; of a
    window of one word one posting does. Shifts are dealt to cells of ``slack + 1``: those of one cell are
    near each other, all others that are near lie in neighbouring cells. A cell keeps bounds and its
    distinct shifts, ``slack + 1`` at most. Where no two postings of it meet, all have the same place in
    the item or in the document, so that the shifts give back the postings and neighbours are compared exactly.
    """
    hits = index.where("term <> 0").join(small(chosen), "term")
    shift = F.col("pos") - 1 - F.col("at")
    hits = hits.select(
        "key", "item", "need", "at", "pos", shift.alias("shift"), F.floor(shift / F.lit(slack + 1)).alias("cell")
    )
    cells = hits.groupBy("key", "item", "cell").agg(
        F.min("need").alias("need"),
        F.min("at").alias("low"),
        F.max("at").alias("high"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
        F.collect_set("shift").alias("shifts"),
    )
    cells = stored(cells.withColumn("met", F.expr("need = 1 or (low < high and first < last)")), "near-cells")
    here = F.struct("low", "high", "first", "shifts")
    pairs = cells.where("not met").select("key", "item", F.explode(F.array("cell", F.col("cell") - 1)).alias("pair"), "cell", here.alias("here"))
    pairs = pairs.groupBy("key", "item", "pair").agg(
        F.first(F.when(F.col("cell") == F.col("pair"), F.col("here")), ignorenulls=True).alias("a"),
        F.first(F.when(F.col("cell") != F.col("pair"), F.col("here")), ignorenulls=True).alias("b"),
    )

    def at(cell: Column, x: Column) -> Column:
        return F.when(cell["low"] == cell["high"], cell["low"]).otherwise(cell["first"] - 1 - x)

    def meet(x: Column, y: Column) -> Column:
        i, j = at(F.col("a"), x), at(F.col("b"), y)
        return (y - x <= slack) & (i != j) & (x + i != y + j)

    near = F.exists("a.shifts", lambda x: F.exists("b.shifts", lambda y: meet(x, y)))
    pairs = pairs.where(F.col("a").isNotNull() & F.col("b").isNotNull()).where(near)
    return cells.where("met").select("key", "item").union(pairs.select("key", "item")).distinct()


def near_items(docs: DataFrame, benchmark: DataFrame, width: int = 13, slack: int = 3) -> DataFrame:
    """``(doc_id, key, n_near)``, one row per row of ``docs``: the number of items that ``proximity`` finds in it.

    An item with a window in the document is among them. Null and repeated ids and texts as in ``contamination``.
    """
    items = item_table(benchmark, width)
    terms = items.select(F.explode("words").alias("word")).select(_term(F.col("word")).alias("term"))
    index = build_index(docs, terms.distinct())
    near = proximity(index, anchors(items, index), slack)
    ids = items.select("item", F.coalesce("item_id", F.lit("-")).alias("item_id"))
    near = near.join(small(ids), "item").select("key", "item_id").distinct()
    counts = stored(near.groupBy("key").agg(F.count(F.lit(1)).alias("n_near")), "near-items")
    rows = index.where("term = 0").select("doc_id", "key").join(small(counts), "key", "left")
    return rows.select("doc_id", "key", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"))


def occurrences(docs: DataFrame, items: DataFrame, found: DataFrame) -> DataFrame:
    """``(key, item, first, last)``: the longest passages of texts, places from 0, that windows of an item cover.

    One row a diagonal: its item's words are compared with the text's words at their places, and the places
    that agree fall into runs; those of ``k`` places and more are whole windows. A text that many rows have
    is compared once. No group is larger than an item.
    """
    suspects = small(stored(found.select("key").distinct(), "suspect-keys"))
    texts = docs.select(content_key().alias("key"), "text").join(suspects, "key", "left_semi")
    texts = texts.groupBy("key").agg(F.first("text").alias("text"))
    places = texts.select("key", F.posexplode(words()).alias("place", "word"))
    size = F.octet_length(F.array_join("words", " ")) + 64
    wanted = found.join(small_in_bytes(items.select("item", "words", "k"), size), "item")
    wanted = wanted.select("key", "item", "shift", "k", F.posexplode("words").alias("at", "word"))
    wanted = wanted.withColumn("place", F.col("shift") + F.col("at"))
    agree = wanted.join(places, ["key", "place", "word"])
    one = ["key", "item", "shift"]
    run = F.col("at") - F.row_number().over(Window.partitionBy(*one).orderBy("at"))
    runs = agree.withColumn("run", run).groupBy(*one, "run").agg(
        F.min("place").alias("first"), F.max("place").alias("last"), F.first("k").alias("k")
    )
    return runs.where(F.col("last") - F.col("first") + 1 >= F.col("k")).select("key", "item", "first", "last")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13, share: int = 20) -> DataFrame:
    """``(doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated)``, one row per row of ``docs``.

    A window is ``width`` consecutive words of an item, or all words of a shorter one. A word of the
    document is hit if it lies inside an occurrence of a window; ``contaminated`` if some word is hit and
    ``share * n_hit >= n_words``. A null text has no words; null ids and repeated rows stay; an item
    without words has no windows, a null item id is listed as ``-``; either table may be empty.
    """
    items = item_table(benchmark, width)
    terms = items.select(F.explode("words").alias("word")).select(_term(F.col("word")).alias("term"))
    index = build_index(docs, terms.distinct())
    found = stored(diagonals(index, anchors(items, index)), "diagonals")
    hits = stored(occurrences(docs, items, found), "occurrences")
    places = hits.select("key", "first", "last").distinct()
    places = places.select("key", F.explode(F.sequence("first", "last")).alias("place")).distinct()
    places = places.groupBy("key").agg(F.count(F.lit(1)).alias("n_hit"))
    ids = hits.select("key", "item").distinct().join(small(items.select("item", "item_id")), "item")
    ids = ids.groupBy("key").agg(F.array_sort(F.collect_set(F.coalesce("item_id", F.lit("-")))).alias("ids"))
    judged = stored(places.join(ids, "key"), "judged")
    judged = small_in_bytes(judged, F.octet_length(F.array_join("ids", ",")) + 64)
    rows = index.where("term = 0").join(judged, "key", "left").select(
        "doc_id",
        "key",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("ids", F.array().cast("array<string>")).alias("ids"),
    )
    return rows.select(
        "doc_id",
        "key",
        "n_words",
        "n_hit",
        F.size("ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, width: int = 13, share: int = 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept; see ``contamination``."""
    judged = contamination(docs, benchmark, width, share)
    own = fresh("key", docs.columns)
    bad = stored(judged.where("contaminated").select(F.col("key").alias(own)).distinct(), "contaminated")
    return docs.join(small(bad), content_key() == F.col(own), "left_anti")


ORACLE_SQL = """
with w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
b as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from benchmark),
g as (
    select item_id, least(len(words), 13) as k, array_to_string(list_slice(words, i, i + least(len(words), 13) - 1), ' ') as gram
    from (select item_id, words, unnest(range(1, len(words) - least(len(words), 13) + 2)) as i from b where len(words) > 0)),
ks as (select distinct k from g),
d as (
    select doc_id, k, i, array_to_string(list_slice(words, i, i + k - 1), ' ') as gram
    from (select doc_id, words, k, unnest(range(1, len(words) - k + 2)) as i from w, ks where len(words) >= k)),
h as (select distinct doc_id, item_id, d.k, i from d join g on d.gram = g.gram and d.k = g.k),
p as (select doc_id, count(distinct i + o) as n_hit from (select doc_id, i, unnest(range(0, k)) as o from h) group by doc_id),
n as (
    select doc_id, count(*) as n_items, sha256(string_agg(item_id, ',' order by item_id)) as items_sha256
    from (select distinct doc_id, cast(item_id as varchar) as item_id from h) group by doc_id)
select w.doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
    cast(coalesce(n_items, 0) as bigint) as n_items, coalesce(items_sha256, sha256('')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from w left join p on w.doc_id = p.doc_id left join n on w.doc_id = n.doc_id
"""
