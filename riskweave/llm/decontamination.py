"""Benchmark decontamination by winnowing, with DataFrame functions only.

A shared window of ``WINDOW`` words contains ``WINDOW - GRAM + 1`` grams. Winnowing
keeps the least gram hash of every run of so many grams, so both texts keep the same
gram of each shared window: joining the kept hashes finds every one. The hits are
then extended to both sides, to the windows that hold them, and count if all words of
such a window are those of an item's. Items shorter than a window are one window
of their own and are joined by the hash of all their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.text import fresh
from riskweave.operators.joins import measure, sized_join
from riskweave.sources.workspace import settle

WINDOW = 10
GRAM = 5
BLOCK = 64  # positions of a text that are looked at together
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = "array<string>"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text in lower case (A to Z only); a NULL text has none."""
    text = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(text, _SEPARATORS), "")


def _each(first, last: Column, make) -> Column:
    """``make`` for each position from first to last; an empty array if there is none."""
    positions = F.sequence(F.lit(first), F.greatest(last, F.lit(first)))
    return F.when(last >= first, F.transform(positions, make)).otherwise(F.array())


def _gram_hash(words: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(length)])


def _with_grams(df: DataFrame) -> DataFrame:
    """From ``words``: their number ``n`` and the hash of the gram at each position."""
    counted = df.withColumn("n", F.size("words"))
    last = F.col("n") - GRAM
    return counted.withColumn(
        "grams", _each(0, last, lambda at: _gram_hash(F.col("words"), at, GRAM))
    )


def _kept() -> Column:
    """Least gram hash of each window, each hash once."""
    span = WINDOW - GRAM + 1
    least = lambda at: F.least(*[F.get("grams", at + i) for i in range(span)])
    return F.array_distinct(_each(0, F.col("n") - WINDOW, least))


def _short_hashes(lengths: list[int]) -> list[Column]:
    """Hashes of all runs of the lengths that short items have."""
    hashes = lambda m: lambda at: _gram_hash(F.col("words"), at, m)
    return [F.array_distinct(_each(0, F.col("n") - m, hashes(m))) for m in lengths]


def _item_window(length: int):
    def make(at: Column) -> Column:
        return F.struct(
            _gram_hash(F.col("words"), at, length).alias("hash"),
            F.lit(length).alias("need"),
            F.slice("words", at + 1, length).alias("window_words"),
        )

    return make


def _items(benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, list[int]]:
    """What texts are held against, and the word numbers of items shorter than a window.

    ``hash``: fingerprints, the winnowed grams and the whole short items.
    ``hash, need, window, window_words``: each distinct window once, in however many items.
    ``window, item``: the items of each window.
    """
    item = F.col("item_id").cast("string").alias("item")
    own = benchmark.select(item, words_of(F.col("text")).alias("words")).distinct()
    grams = settle(_with_grams(own).where("n > 0"))
    short = grams.where(F.col("n") < WINDOW).select("n").distinct().collect()  # at most 9 rows
    lengths = sorted(row["n"] for row in short)

    whole = grams.where(F.col("n") >= WINDOW)
    prints = whole.withColumn("kept", _kept()).select(F.explode("kept").alias("hash"))
    windows = None
    for m in [*lengths, WINDOW]:
        those = whole if m == WINDOW else grams.where(F.col("n") == m)
        each = _each(0, F.col("n") - m, _item_window(m))
        found = those.select("item", F.explode(each).alias("w")).select("item", "w.*")
        windows = found if windows is None else windows.unionByName(found)
        if m < WINDOW:
            prints = prints.unionByName(found.select("hash"))
    windows = settle(
        windows.withColumn("window", F.md5(F.concat_ws(" ", "window_words"))).distinct()
    )
    distinct = settle(windows.drop("item").distinct())
    members = settle(windows.select("window", "item").distinct())
    return settle(prints.distinct()), distinct, members, lengths


def _blocks() -> Column:
    """``words`` cut into blocks: the place of the first own position, that of the first
    word, and the words a window around an own position can reach."""
    reach = WINDOW - GRAM
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(BLOCK))

    def block(start: Column) -> Column:
        first = F.greatest(start - reach, F.lit(0))
        return F.struct(
            start.alias("start"),
            first.alias("first"),
            F.slice("words", first + 1, reach + BLOCK + WINDOW - 1).alias("part"),
        )

    return F.transform(starts, block)


def _runs(length: int) -> Column:
    """``at, hash`` of the runs of some length that start at an own position of a block."""
    lead = F.col("start") - F.col("first")
    last = F.least(lead + BLOCK - 1, F.size("part") - length)
    make = lambda at: F.struct(
        at.alias("at"), _gram_hash(F.col("part"), at, length).alias("hash")
    )
    return F.when(last >= lead, F.transform(F.sequence(lead, F.greatest(last, lead)), make)).otherwise(
        F.array()
    )


def _windows_around(at: Column) -> Column:
    """``at, hash`` of the windows of a block that hold the gram at a place."""
    first = F.greatest(at - (WINDOW - GRAM), F.lit(0))
    last = F.least(at, F.size("part") - WINDOW)
    make = lambda s: F.struct(s.alias("at"), _gram_hash(F.col("part"), s, WINDOW).alias("hash"))
    return F.when(last >= first, F.transform(F.sequence(first, F.greatest(last, first)), make)).otherwise(
        F.array()
    )


def _text_windows(texts: DataFrame, prints: DataFrame, lengths: list[int]) -> DataFrame:
    """``text_key, place, need, hash, run``: runs of words of a text that may be a window.

    Texts are cut into blocks. A gram among the fingerprints is extended to the windows
    that hold it; runs as long as a short item are taken as they are.
    """
    worded = texts.select("text_key", words_of(F.col("text")).alias("words"))
    blocks = worded.select("text_key", F.explode(_blocks()).alias("b")).select("text_key", "b.*")
    base = ["text_key", "start", "first", "part"]

    def exploded(df: DataFrame, runs: Column) -> DataFrame:
        return df.select(*base, F.explode(runs).alias("r")).select(*base, "r.*")

    grams = exploded(blocks, _runs(GRAM))
    size = measure(prints)
    hits = sized_join(grams, prints, "hash", "left_semi", size, salt_by=["text_key", "start", "at"])
    found = exploded(hits, _windows_around(F.col("at"))).withColumn("need", F.lit(WINDOW))
    for m in lengths:
        found = found.unionByName(exploded(blocks, _runs(m)).withColumn("need", F.lit(m)))
    return found.select(
        "text_key",
        (F.col("first") + F.col("at")).alias("place"),
        "need",
        "hash",
        F.slice("part", F.col("at") + 1, F.col("need")).alias("run"),
    )


def _covered(spans: DataFrame) -> DataFrame:
    """``text_key, n_hit``: words of each text covered by its windows."""
    order = Window.partitionBy("text_key").orderBy("place", "need")
    end = F.col("place") + F.col("need")
    upto = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), end - F.greatest("place", F.coalesce(upto, F.lit(0))))
    return spans.withColumn("new", new).groupBy("text_key").agg(F.sum("new").alias("n_hit"))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``text_key, n_hit, items`` of each distinct text that has a window of an item.

    A text is known by its MD5, so that copies are looked at once. Only texts that share
    a fingerprint are looked at again, and in these only the surroundings of the hits.
    A hit is joined to distinct windows, so that it does not matter how many items
    share its words; items are named once per text and window.
    """
    prints, windows, members, lengths = _items(benchmark)
    text_key = F.md5(F.col("text").cast("binary")).alias("text_key")
    keyed = docs.where(F.col("text").isNotNull()).select(text_key, "text")

    grams = _with_grams(keyed.select("text_key", words_of(F.col("text")).alias("words")))
    hashes = F.array_distinct(F.concat(_kept(), *_short_hashes(lengths)))
    kept = grams.select("text_key", F.explode(hashes).alias("hash"))
    hits = sized_join(kept, prints, "hash", "left_semi", measure(prints), salt_by=["text_key"])
    chosen = settle(hits.select("text_key").distinct())

    near = sized_join(keyed, chosen, "text_key", "left_semi", measure(chosen), salt_by=["text_key"])
    texts = near.groupBy("text_key").agg(F.first("text").alias("text"))
    runs = _text_windows(texts, prints, lengths)
    matched = sized_join(
        runs, windows.withColumnRenamed("need", "length"), "hash", "inner",
        measure(windows.drop("window_words")), salt_by=["text_key", "place"],
    )
    same = (F.col("need") == F.col("length")) & (F.col("run") == F.col("window_words"))
    spans = settle(matched.where(same).select("text_key", "place", "need", "window").distinct())
    named = sized_join(
        spans.select("text_key", "window").distinct(), members, "window", "inner",
        measure(members), salt_by=["text_key"],
    )
    items = named.groupBy("text_key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return settle(_covered(spans.drop("window").distinct()).join(items, "text_key"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words, n_hit, items``, the ids of the items found.

    A NULL or empty text and an item without words have no window. A NULL item_id
    counts as hit but not as an item. Repeated rows come back repeated; repeated
    items count once by their id; an empty table of items hits nothing. Columns
    named like an added one are replaced.
    """
    found = contaminated_texts(docs, benchmark)
    key, n_hit, items = (fresh(docs, n) for n in ("_text_key", "_n_hit", "_items"))
    renamed = found.toDF(key, n_hit, items)
    sizes = measure(found.select("text_key", "n_hit", F.concat_ws(",", "items").alias("items")))
    keyed = docs.withColumn(key, F.md5(F.col("text").cast("binary")))
    by = ["doc_id"] if "doc_id" in docs.columns else None
    joined = sized_join(keyed, renamed, key, "left", sizes, salt_by=by)
    return joined.withColumns(
        {
            "n_words": F.size(words_of(F.col("text"))).cast("bigint"),
            "n_hit": F.coalesce(F.col(n_hit), F.lit(0)).cast("bigint"),
            "items": F.coalesce(F.col(items), F.array().cast(_WORDS)),
        }
    ).drop(key, n_hit, items)


def decontamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for each row."""
    return decontaminate(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows without any window of an item, with all their columns."""
    found = contaminated_texts(docs, benchmark).select("text_key")
    key = fresh(docs, "_text_key")
    keyed = docs.withColumn(key, F.md5(F.col("text").cast("binary")))
    renamed = found.toDF(key)
    by = ["doc_id"] if "doc_id" in docs.columns else None
    left = sized_join(keyed, renamed, key, "left_anti", measure(renamed), salt_by=by)
    return left.select(docs.columns)
