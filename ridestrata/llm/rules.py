"""Quality rules and a log-likelihood ratio of hashed n-grams, in DataFrame operations.

The n-grams of a text are its words and its pairs of neighbouring words, the last word with
the end of the text, hashed into ``buckets`` places. Two multinomials over the places, one
of trusted texts and one of the whole corpus, give each place the logarithm of its ratio; a
text's score is the mean over its n-grams, so length does not count. Texts that break no
base rule are kept if the score reaches the threshold."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridestrata.operators.stored import store

BUCKETS = 1 << 18
THRESHOLD = -0.25
_SPACE = r"[\x20\x09-\x0D]+"
_EDGES = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, none of a null one."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(_EDGES))
    return F.when(F.length(inner) > 0, F.split(inner, _SPACE)).otherwise(F.array().cast("array<string>"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column, hashes: Column, width: int) -> Column:
    """Words in windows of ``width`` words that the text holds twice or more; ``hashes`` has
    one number per word."""
    count = F.size(words) - (width - 1)

    def covered(starts: Column) -> Column:
        follower = lambda i: F.coalesce(F.get(starts, i + 1), F.lit(2**31 - 1))
        reach = F.transform(starts, lambda start, i: F.least(F.lit(width), follower(i) - start))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda total, n: total + n)

    def doubled(order: Column) -> Column:
        same = lambda w, i: F.get(order, i)["w"].eqNullSafe(w["w"])
        return F.filter(order, lambda w, i: same(w, i - 1) | same(w, i + 1))

    # Equal windows have equal hashes, so only texts with an equal pair are looked at closely,
    # and of these only the windows whose hash comes again.
    named = F.transform(
        F.slice(hashes, 1, count), lambda first, i: F.xxhash64(first, *[F.get(hashes, i + k) for k in range(1, width)])
    )
    suspect = F.size(F.array_distinct(named)) < count
    numbered = F.transform(named, lambda found, i: F.struct(found.alias("w"), (i + 1).alias("at")))
    windows = F.transform(
        _let(F.sort_array(numbered), doubled),
        lambda near: F.struct(F.array_join(F.slice(words, near["at"], width), " ").alias("w"), near["at"].alias("at")),
    )
    starts = F.sort_array(F.transform(_let(F.sort_array(windows), doubled), lambda w: w["at"]))
    exact = _let(starts, covered)
    return F.when(F.size(words) <= width, F.lit(0).cast("long")).when(suspect, exact).otherwise(F.lit(0).cast("long"))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def with_base_rules(docs: DataFrame, hashes: str = "_rs_hashes") -> DataFrame:
    """``docs`` (doc_id, text) with the counts of the base rules and a hash of each word."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.col("_rs_words")
    split = docs.select("doc_id", text.alias("_rs_text"), words_of(F.col("text")).alias("_rs_words"))
    split = split.withColumn(hashes, _hashes(words))
    lines = F.filter(F.split("_rs_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = split.select(
        "doc_id",
        hashes,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count("_rs_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
        _repeat_words(words, F.col(hashes), 5).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _places(hashes: Column, buckets: int) -> Column:
    """The places of a text's n-grams, from the hashes of its words: the words, then the pairs."""
    place = lambda *parts: F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")
    pairs = F.transform(hashes, lambda word, i: place(word, F.get(hashes, i + 1)))
    return F.concat(F.transform(hashes, lambda word: place(word)), pairs)


def ratios(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(place, ratio): the log-likelihood ratio of each of the ``buckets`` places between
    the ``trusted`` texts of ``docs`` (text, trusted) and all of them, from all n-grams,
    each count raised by one half. Both are counted in one pass and summed before the
    shuffle; the table has one row per place whatever the data."""
    hashed = docs.select("trusted", _hashes(words_of(F.col("text"))).alias("_rs_hashes"))
    places = hashed.select("trusted", F.explode(_places(F.col("_rs_hashes"), buckets)).alias("place"))
    counts = places.groupBy("place").agg(F.count_if("trusted").alias("t"), F.count("*").alias("c"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("place"))
    both = store(every.join(counts, "place", "left").na.fill(0), "places")
    total = both.agg(F.sum("t").alias("t_all"), F.sum("c").alias("c_all"))
    share = lambda n, whole: (F.col(n) + 0.5) / (F.col(whole) + 0.5 * buckets)
    return both.withColumns(
        {"t_all": total.select("t_all").scalar(), "c_all": total.select("c_all").scalar()}
    ).select("place", F.log(share("t", "t_all") / share("c", "c_all")).alias("ratio"))


def ruled(docs: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, counts, base_failed, score and kept per row of ``docs`` (doc_id, text,
    trusted).

    ``trusted`` marks the target texts; null is false. A null text has no words and fails the base
    rules, with score 0. A score equal to the threshold is kept. Repeated rows come back
    repeated, an empty table gives no rows; without trusted texts every ratio is that of an
    even multinomial. Other columns are not read."""
    table = store(ratios(docs, buckets), "ratios")
    # The table has ``buckets`` rows, so as one array it has a bound of its own.
    listed = table.agg(F.sort_array(F.collect_list(F.struct("place", "ratio"))).alias("rows"))
    weights = store(listed.select(F.col("rows.ratio").alias("weights")), "weights").scalar()
    marked = with_base_rules(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    weighted = marked.withColumn("_rs_weights", weights)
    total = F.aggregate(
        _places(F.col("_rs_hashes"), buckets),
        F.lit(0.0),
        lambda acc, place: acc + F.get(F.col("_rs_weights"), place),
    )
    score = F.when(F.col("n_words") > 0, total / (2 * F.col("n_words"))).otherwise(F.lit(0.0))
    scored = weighted.withColumn("score", score)
    kept = ~F.col("base_failed") & (F.col("score") >= threshold)
    return scored.withColumn("kept", kept).drop("_rs_hashes", "_rs_weights")
