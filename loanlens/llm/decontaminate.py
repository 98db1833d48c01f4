"""Benchmark passages in training text, found with DataFrame functions alone.

The windows of the benchmark (n consecutive words, or all words of a shorter item) are a
set of hashes that goes to every task. A window can only occur in a text that holds its
longest word, so a text without any of those words is dismissed at once. In the others
every window of tokens is hashed and looked up, and a hit is verified word by word.

The windows are counted first. A set of bounded size is broadcast; a larger one is joined
like any table, with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import cut_lineage, free_name, named, sha256_hex, text_or_empty

# Upper and lower case letters, and the runs of characters that are words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# A benchmark of so many windows at most (13 short words each, some 2 MB) goes to every
# task as a literal set; larger ones are joined, as Spark's planner decides by their size.
MAX_LITERAL_WINDOWS = 20_000


def normal_words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; other letters keep their case."""
    # Words are cut first: only then is it known which of them are ASCII and can be
    # lowered in one go; lowering others would change letters beyond A-Z.
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))).otherwise(
        F.transform(
            words,
            lambda w: F.when(F.octet_length(w) == F.length(w), F.lower(w)).otherwise(
                F.translate(w, UPPER, LOWER)
            ),
        )
    )


def _window(words: Column, at: Column, n: Column | int) -> Column:
    return F.array_join(F.slice(words, at + 1, n), " ")


def _window_hashes(words: Column, n: int) -> Column:
    places = F.sequence(F.lit(0), F.size(words) - n)
    return F.transform(places, lambda at: F.xxhash64(_window(words, at, n)))


def benchmark_windows(items: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """Every distinct window: its words, length, hash, anchor word and the anchor's place."""
    words = items.select(
        F.col(id_col).cast("string").alias("item"), normal_words(text_or_empty(text_col)).alias("w")
    ).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(n))
    spread = words.select(
        "item", "w", length.alias("n"), F.explode(F.sequence(F.lit(0), F.size("w") - length)).alias("at")
    ).select("item", "n", _window(F.col("w"), F.col("at"), F.col("n")).alias("window"))
    parts = F.split("window", " ")
    # The longest word, the first of several: rare in most languages.
    longest = F.array_max(F.transform(parts, F.length))
    anchor = F.get(F.filter(parts, lambda w: F.length(w) == longest), F.lit(0))
    return spread.distinct().withColumn("anchor", anchor)


def _merged(hits: Column) -> Column:
    """Sorted (start, end) pairs with overlapping and touching ones united."""
    pair = "struct<start:int,end:int>"
    none = F.array().cast(f"array<{pair}>")

    def step(state: Column, hit: Column) -> Column:
        out, open_ = state["out"], state["open"]
        joins = hit["start"] <= open_["end"]
        return F.when(
            joins,
            F.struct(
                out.alias("out"),
                F.struct(
                    open_["start"].alias("start"), F.greatest(open_["end"], hit["end"]).alias("end")
                ).alias("open"),
            ),
        ).otherwise(
            F.struct(
                F.when(open_["start"].isNull(), out).otherwise(F.concat(out, F.array(open_))).alias("out"),
                hit.alias("open"),
            )
        )

    start = F.struct(none.alias("out"), F.lit(None).cast(pair).alias("open"))
    last = lambda s: F.concat(s["out"], F.array(s["open"]))
    return F.aggregate(F.array_sort(hits), start, step, last)


FOUND = "array<struct<at:int,n:int,window:string>>"


def _scan_with_sets(texts: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """Windows found in every text, with two sets that are literals of the plan.

    A text without an anchor word is done; in others the hashes of all windows of tokens
    are looked up. Nothing but the windows found leaves a row.
    """
    anchors = [r["anchor"] for r in windows.select("anchor").distinct().collect()]
    per_size = []
    for size in sizes:
        at_size = windows.where(F.col("n") == size).select(F.xxhash64("window").alias("hash"))
        hashes = [r["hash"] for r in at_size.distinct().collect()]
        per_size.append(_places_in(F.col("w"), size, hashes))
    found = F.when(F.exists("w", lambda w: w.isin(anchors)), F.concat(*per_size))
    return texts.withColumn("found", F.coalesce(found, F.array().cast(FOUND)))


def _places_in(words: Column, n: int, hashes: list[int]) -> Column:
    places = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(
        F.array().cast("array<int>")
    )
    hits = F.filter(places, lambda at: F.xxhash64(_window(words, at, n)).isin(hashes))
    return F.transform(
        hits,
        lambda at: F.struct(at.alias("at"), F.lit(n).alias("n"), _window(words, at, n).alias("window")),
    )


def _scan_with_joins(texts: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """The same for windows of any number: hashes of all windows of tokens, joined."""
    hashes = windows.select("n", F.xxhash64("window").alias("hash")).distinct()
    places = None
    for size in sizes:
        scanned = texts.where(F.size("w") >= size).select(
            "row", F.posexplode(_window_hashes(F.col("w"), size)).alias("at", "hash")
        )
        hit = scanned.join(hashes.where(F.col("n") == size), "hash", "left_semi")
        hit = hit.select("row", "at", F.lit(size).alias("n"))
        places = hit if places is None else places.unionByName(hit)
    places = places.groupBy("row").agg(F.collect_list(F.struct("at", "n")).alias("places"))
    found = F.transform(
        "places",
        lambda p: F.struct(
            p["at"].alias("at"), p["n"].alias("n"), _window(F.col("w"), p["at"], p["n"]).alias("window")
        ),
    )
    return texts.join(places, "row", "left").withColumn("found", F.coalesce(found, F.array().cast(FOUND)))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    n: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    literal_limit: int = MAX_LITERAL_WINDOWS,
) -> DataFrame:
    """Per row of ``docs``: its words, the words inside benchmark windows, and the items.

    Columns: ``id``, ``text_hash`` (of the text, null as empty), ``n_words``, ``hits``
    (word ranges start-end that are hit, end exclusive, sorted and apart), ``n_hit``,
    ``items`` (ids of items with occurring windows, sorted as strings). Null or wordless
    texts have no words and no hits, wordless items no window; equal items all count;
    repeated rows are judged each; an empty table on either side gives no hits. Other
    columns are not read.
    """
    windows = cut_lineage(benchmark_windows(items, n, item_id, item_text))
    sizes = [r["n"] for r in windows.select("n").distinct().collect()]  # n values at most
    small = windows.count() <= literal_limit

    texts = docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64(text_or_empty(text_col)).alias("text_hash"),
        normal_words(text_or_empty(text_col)).alias("w"),
    )
    if not sizes:
        seen = texts.withColumn("found", F.array().cast(FOUND))
    elif small:
        seen = _scan_with_sets(texts, windows, sizes)
    else:
        seen = _scan_with_joins(cut_lineage(texts), windows, sizes)
    seen = cut_lineage(
        seen.select("id", "row", "text_hash", F.size("w").cast("long").alias("n_words"), "found")
    )

    # Verified word by word: the text of the window has to be that of the item.
    known_windows = windows.select("n", "window", "item")
    if small:
        known_windows = F.broadcast(known_windows)
    pair = F.struct(F.col("at").alias("start"), (F.col("at") + F.col("n")).alias("end"))
    verified = (
        seen.select("row", F.inline("found"))
        .join(known_windows, ["n", "window"])
        .groupBy("row")
        .agg(_merged(F.collect_set(pair)).alias("hits"), F.array_sort(F.collect_set("item")).alias("items"))
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    hits = F.coalesce("hits", none)
    return (
        seen.select("id", "row", "text_hash", "n_words")
        .join(verified, "row", "left")
        .select(
            "id",
            "text_hash",
            "n_words",
            hits.alias("hits"),
            F.aggregate(hits, F.lit(0).cast("long"), lambda a, h: a + h["end"] - h["start"]).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def is_contaminated(share: int = 20) -> Column:
    """At least one word in ``share`` is hit, and at least one at all."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    remove: str = "documents",
    share: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """``docs`` without contaminated documents, or without hit words (``remove="spans"``).

    Rows meet their verdict by id (null is an id too) and text. With ``spans`` hit words
    go together with the separators before them, in every document; other columns stay and
    may have any names. Null and wordless texts have no hits and stay; repeated rows share
    a verdict; an empty table on either side changes nothing.
    """
    judged = contamination(docs, items, id_col=id_col, text_col=text_col, **options)
    judged = judged.where(is_contaminated(share) if remove == "documents" else F.col("n_hit") > 0)
    judged = judged.select("id", "text_hash", "hits").dropDuplicates(["id", "text_hash"])
    # Written, so that the planner knows their size and broadcasts them only if small.
    own_id, own_hash, hits = (free_name(docs, name) for name in ("_id", "_hash", "_hits"))
    marks = cut_lineage(judged.toDF(own_id, own_hash, hits))
    same = F.col(id_col).eqNullSafe(F.col(own_id)) & (F.xxhash64(text_or_empty(text_col)) == F.col(own_hash))
    if remove == "documents":
        return docs.join(marks, same, "left_anti")
    separator = WORD.replace("[^", "[")
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(rf"(?:{separator[:-1]}*){WORD}"), F.lit(0))
    tail = F.regexp_extract(F.col(text_col), rf"{separator[:-1]}*$", 0)
    left = F.filter(pieces, lambda p, i: ~F.exists(hits, lambda h: (h["start"] <= i) & (i < h["end"])))
    cut = F.concat(F.array_join(left, ""), tail)
    joined = docs.join(marks, same, "left")
    return joined.withColumn(text_col, F.when(F.col(hits).isNull(), F.col(text_col)).otherwise(cut)).select(
        *named(docs)
    )
