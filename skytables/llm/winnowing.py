"""Benchmark decontamination by winnowing.

The fingerprint of a text is the least hash of ``gram`` words in every run of ``span`` words. A span of that length shared
by a document and an item gives both the same least hash, so joining fingerprints misses no shared span. Every hit is then
extended word by word along its diagonal, and runs of at least ``span`` equal words count: the result is exact.

Items shorter than ``span`` words have one window, the whole item; it is looked up by the hash of its words. Texts that occur
many times are treated once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytables.llm.columns import NOT_ALNUM, lower_ascii, text_of, unused, words
from skytables.session import materialise


def item_words(text: str | Column) -> Column:
    return words(lower_ascii(text_of(text)), NOT_ALNUM)


def _grams(array: str, size: int) -> Column:
    """Hash of every run of ``size`` words; an empty array if there are fewer words."""
    places = F.when(F.size(array) >= size, F.sequence(F.lit(0), F.size(array) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.lit(size), *[F.get(F.col(array), i + k) for k in range(size)]))


def _least(hashes: str, window: int) -> Column:
    """Least hash of each window; at the end, of what is left of one, which only adds fingerprints."""
    return F.transform(F.col(hashes), lambda x, i: F.least(x, *[F.get(F.col(hashes), i + k) for k in range(1, window)]))


def _text_key(text: str) -> Column:
    return F.md5(text_of(text).cast("binary"))


def shared_spans(documents: DataFrame, benchmark: DataFrame, *, text: str, item: str, item_text: str, span: int, gram: int) -> DataFrame:
    """(fp, item, pos): every word of a text, named by its md5, that lies in a shared span, and the item's id as a string."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), item_words(item_text).alias("iw")).filter(F.size("iw") > 0)
    items = items.withColumn("ikey", F.md5(F.concat_ws(" ", "iw").cast("binary")))
    items = materialise(items)
    files = 1 + items.count() // 100_000  # few files, so that the planner sees the true size of what it may broadcast
    whole = items.select("ikey", "iw").dropDuplicates(["ikey"])
    window = span - gram + 1
    long_items = whole.filter(F.size("iw") >= span).withColumn("g", _grams("iw", gram))
    at = F.transform(F.sequence(F.lit(0), F.size("g") - 1), lambda q: F.struct(F.get(F.col("g"), q).alias("hash"), q.alias("q")))
    least = F.slice(_least("g", window), F.lit(1), F.size("g") - window + 1)
    long_items = long_items.withColumn("least", F.array_distinct(least)).withColumn("at", at)
    seeds = long_items.select("ikey", F.inline("at"), "least").filter(F.array_contains("least", F.col("hash"))).drop("least")
    lengths = sorted(r[0] for r in whole.select(F.size("iw")).filter(F.size("iw") < span).distinct().collect())
    for n in lengths:
        short = whole.filter(F.size("iw") == n).select("ikey", F.get(_grams("iw", n), F.lit(0)).alias("hash"), F.lit(0).alias("q"))
        seeds = seeds.unionByName(short)
    seeds = materialise(seeds.repartition(files))
    hashes = materialise(seeds.select("hash").distinct().repartition(files))

    def with_hashes(df: DataFrame, winnowed: bool) -> DataFrame:
        df = df.withColumn("g", _grams("w", gram))
        picked = F.array_distinct(_least("g", window)) if winnowed else F.col("g")
        df = df.withColumn("found", picked)
        for n in lengths:
            df = df.withColumn(f"short{n}", _grams("w", n))
        return df

    texts = documents.select(_text_key(text).alias("fp"), F.col(text).alias("text"))
    marks = with_hashes(texts.select("fp", item_words("text").alias("w")), True)
    marks = marks.select("fp", F.explode(F.concat("found", *[f"short{n}" for n in lengths])).alias("hash"))
    suspects = materialise(marks.join(hashes, "hash", "left_semi").select("fp").distinct())

    own = texts.join(suspects, "fp", "left_semi").groupBy("fp").agg(F.max("text").alias("text"))
    own = materialise(own.select("fp", item_words("text").alias("w")))
    placed = with_hashes(own, False)
    placed = placed.select(
        "fp",
        F.inline(
            F.concat(
                *[
                    F.transform(c, lambda x, p: F.struct(p.alias("p"), x.alias("hash")))
                    for c in ("found", *[f"short{n}" for n in lengths])
                ]
            )
        ),
    )
    diagonals = placed.join(seeds, "hash").select("fp", "ikey", (F.col("p") - F.col("q")).alias("shift")).distinct()
    aligned = materialise(diagonals).join(whole, "ikey").join(own, "fp")
    equal = F.filter(
        F.sequence(F.lit(0), F.size("iw") - 1),
        lambda j: (F.col("shift") + j >= 0) & F.coalesce(F.get("w", F.col("shift") + j) == F.get("iw", j), F.lit(False)),
    )
    least_run = F.least(F.size("iw"), F.lit(span)).alias("need")
    matched = aligned.select("fp", "ikey", "shift", least_run, F.explode(equal).alias("j"))
    line = Window.partitionBy("fp", "ikey", "shift")
    matched = matched.withColumn("run", F.col("j") - F.row_number().over(line.orderBy("j")))
    matched = matched.withColumn("n", F.count("*").over(Window.partitionBy("fp", "ikey", "shift", "run"))).filter("n >= need")
    found = matched.select("fp", "ikey", (F.col("shift") + F.col("j")).alias("pos")).distinct()
    return found.join(items.select("ikey", "item").distinct(), "ikey").select("fp", "item", "pos")


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    span: int = 10,
    gram: int = 5,
) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) for each row of ``documents``.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A word is hit if it lies inside any
    occurrence of ``span`` consecutive words of an item, or of a whole item that is shorter. NULL and empty texts have no
    words, and items without words have no window; items without an id hit words but are not counted. Rows with equal texts
    get equal results; repeated items count once by id. Either table may be empty. Other columns are dropped.
    """
    hits = materialise(
        shared_spans(documents, benchmark, text=text, item=item, item_text=item_text, span=span, gram=gram)
    )
    counts = hits.select("fp", "pos").distinct().groupBy("fp").agg(F.count("*").alias("n_hit"))
    ids = hits.select("fp", "item").distinct().groupBy("fp").agg(F.sort_array(F.collect_list("item")).alias("ids"))
    result = materialise(counts.join(ids, "fp", "left"))
    n_words = F.regexp_count(lower_ascii(text_of(text)), F.lit(NOT_ALNUM.replace("[", "[^", 1))).cast("long")
    rows = documents.select(F.col(key), n_words.alias("n_words"), _text_key(text).alias("fp")).join(result, "fp", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("ids", F.array().cast("array<string>"))
    return rows.select(
        key,
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", span: int = 10, gram: int = 5) -> DataFrame:
    """The documents that share no span with an item, whole and with their own columns."""
    (mark,) = unused(documents, "_fp")
    hit = shared_spans(documents, benchmark, text=text, item=item, item_text=item_text, span=span, gram=gram)
    hit = materialise(hit.select(F.col("fp").alias(mark)).distinct())
    return documents.join(hit, _text_key(text) == hit[mark], "left_anti")
