"""Benchmark decontamination with a hash set of the test items' word windows.

Items and documents are cut into words.  Every run of as many words as a
window has is hashed; a document's hashes meet the distinct windows of the
items in a hash join, whose hits are verified word by word.  The windows are
broadcast while they are few, which is checked; else both sides are shuffled.
All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, free_name, written

WINDOW = 10
# Words are runs of letters, digits and everything beyond ASCII.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same in a text of any case.  Each character outside a word stands by itself:
# Java looks these up in a table, but tries ranges one after the other.
ANY_CASE_WORD = "[^" + "".join(rf"\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
# The same in a text whose A-Z are not lower-cased, with what follows it.
PIECE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
HEAD = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
# The most windows that are broadcast (some 250 bytes each).
MOST_BROADCAST = 200_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(ANY_CASE_WORD), F.lit(0))


def window_hashes(words: Column, length: int) -> Column:
    """The hash of each run of ``length`` words of an array, none if it is shorter."""
    def runs(hashes: Column) -> Column:
        starts = F.when(F.size(hashes) >= length, F.sequence(F.lit(1), F.size(hashes) - (length - 1)))
        return F.transform(starts, lambda i: F.xxhash64(F.lit(length), F.slice(hashes, i, length)))

    # bound to a variable: the words are hashed once, not once a run
    return F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), runs)[0]


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """(item_id, words): the distinct windows of each item, one of all its words if it is shorter."""
    words = items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("all"))
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("all") - (window - 1), F.lit(1))),
                       lambda i: F.slice("all", i, window))
    return words.filter(F.size("all") > 0).select("item_id", F.explode(runs).alias("words")).distinct()


def hits(texts: DataFrame, windows: DataFrame, few: bool, lengths: list[int]) -> DataFrame:
    """(doc_id, print, pos, length, window) of every verified occurrence.

    texts: (doc_id, print, words); windows: (window, hash, words).
    """
    found = None
    for length in lengths:
        # a column of its own and an outer generator: the runs stay in generated
        # code with the join, and no filter computes them a second time
        starts = texts.withColumn("starts", window_hashes(F.col("words"), length)).select(
            "doc_id", "print", "words", F.posexplode_outer("starts").alias("pos", "hash"))
        own = windows.filter(F.size("words") == length).withColumnRenamed("words", "window_words")
        if few:
            met = starts.join(F.broadcast(own), "hash")
        else:  # the words follow the hits only
            met = starts.drop("words").join(own, "hash").alias("m").join(
                texts.dropDuplicates(["doc_id", "print"]).alias("t"), same_text("m", "t")).select("m.*", "t.words")
        # in this form it is checked on the hash's hits, and is no join key
        met = met.filter(F.array_contains(F.array("window_words"), F.slice("words", F.col("pos") + 1, length))).select(
            "doc_id", "print", "pos", F.lit(length).alias("length"), "window")
        found = met if found is None else found.unionByName(met)
    return found


def same_text(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.print") == F.col(f"{b}.print"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(doc_id, print, places, items): what each contaminated text holds, a row per id and text.

    print: ``text_print`` of the text; places: the numbers, from 0, of the
    words inside occurrences of windows, in order; items: the ids of the items
    that have such windows, as strings in order.  Null and empty texts have no
    words.  Rows that repeat id and text share one row; items without words
    have no window; an item's null id counts for places only.
    """
    pairs = written(item_windows(items, item_col, item_text_col, window), "item-windows")
    windows = written(pairs.select("words").distinct().select(
        F.monotonically_increasing_id().alias("window"), "words"), "windows")
    lengths = sorted(r[0] for r in windows.select(F.size("words")).distinct().collect())  # 1 to ``window``
    few = windows.count() <= most_broadcast
    hashed = windows.withColumn("hash", F.xxhash64(F.size("words"), F.transform("words", lambda w: F.xxhash64(w))))
    texts = docs.select(F.col(id_col).alias("doc_id"), text_print(F.col(text_col)).alias("print"),
                        words_of(F.col(text_col)).alias("words"))
    # repeated rows give equal hits; a set of them is one per text, made before the shuffle
    inside = F.flatten(F.transform(F.collect_set(F.struct("pos", "length")),
                                   lambda x: F.sequence(x["pos"], x["pos"] + x["length"] - 1)))
    seen = written(hits(texts, hashed, few, lengths or [window]).groupBy("doc_id", "print").agg(
        F.array_sort(F.array_distinct(inside)).alias("places"), F.collect_set("window").alias("windows")), "hits")
    named = seen.select("doc_id", "print", F.explode("windows").alias("window")).join(
        windows.join(pairs, "words").select("window", "item_id"), "window").groupBy("doc_id", "print").agg(
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    return seen.alias("a").join(named.alias("b"), same_text("a", "b")).select("a.doc_id", "a.print", "a.places", "b.items")


def text_print(text: Column) -> Column:
    """A digest that tells the texts of one id apart; null is empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def contaminated_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                           most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``.

    n_hit: the words inside any occurrence of a window; n_items: the items
    with occurring windows, whose ids items_sha256 digests.  Null texts and
    empty ones have no words; repeated rows each have their own; an empty
    table gives no rows, and without items nothing is hit.  Other columns are
    not read.
    """
    found = written(contamination(docs, items, id_col, text_col, item_col, item_text_col, window, most_broadcast).select(
        F.col("doc_id").alias("hit_id"), F.col("print").alias("hit_print"),
        F.size("places").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("ids")), "found")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_print(F.col(text_col)).alias("print"),
                       F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(ANY_CASE_WORD)).cast("long").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("print") == F.col("hit_print"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(found, same, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  remove: str = "spans", most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``docs`` without what it shares with ``items``: its columns, whole clean rows as they were.

    remove="documents" drops every row with a hit; "spans" takes the hit words
    out of its text, each with what follows up to the next word.  Null texts
    and rows without hits are left alone.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    hit_id, hit_print, gaps = (free_name(docs, x) for x in ("hit_id", "hit_print", "hit_gaps"))
    places = F.col("places")
    before = F.filter(places, lambda x, i: ~F.get(places, i - 1).eqNullSafe(x - 1))  # a run of hit words starts
    after = F.transform(F.filter(places, lambda x, i: ~F.get(places, i + 1).eqNullSafe(x + 1)), lambda x: x + 1)
    found = written(contamination(docs, items, id_col, text_col, item_col, item_text_col, window, most_broadcast).select(
        F.col("doc_id").alias(hit_id), F.col("print").alias(hit_print), F.arrays_zip(
            F.concat(F.array(F.lit(0)), after).alias("start"),
            F.concat(before, F.array(F.lit(None).cast("int"))).alias("end")).alias(gaps)), "found")
    same = F.col(id_col).eqNullSafe(F.col(hit_id)) & (text_print(F.col(text_col)) == F.col(hit_print))
    if remove == "documents":
        return docs.join(found, same, "left_anti")
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(PIECE), F.lit(0))
    left = F.flatten(F.transform(F.col(gaps), lambda g: F.slice(
        pieces, g["start"] + 1, F.coalesce(g["end"], F.size(pieces)) - g["start"])))
    text = F.when(F.col(gaps).isNull(), F.col(text_col)).otherwise(
        F.concat(F.regexp_extract(F.col(text_col), HEAD, 0), F.array_join(left, "")))
    return docs.join(found, same, "left").withColumn(text_col, text).select(docs.columns)
