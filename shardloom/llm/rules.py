"""Quality rules: hashed n-gram log-likelihood ratio, in DataFrame operations only.

Every word and every pair of neighbouring words is a feature, hashed by the words' CRC-32 into
``BUCKETS`` buckets.  Two multinomials over the buckets are counted over the whole table:
the trusted target (texts that the labels call good) and the raw corpus (all texts).  A
text's score is the sum of the log ratios of its features, divided by their number; it is
kept if that mean is at least ``THRESHOLD`` and no base rule fails.  The ratios are whole
millionths, so a score is an exact sum, whatever the order of rows and tasks.

Counts are combined in each task before they are shuffled, at most one row a bucket; the
counts, a row a bucket, are the only thing the driver sees.  Texts move once, in the join
with the labels; a text is scored where it is read.

Defined cases: a null text has no words and fails the base rules; a very long text is
scored whole, in memory in proportion to it; an id is trusted if it has labels and all of
them are 1, and rows that share that id are all trusted; a null ``doc_id`` is not trusted;
without any trusted word the base rules alone decide; repeated rows each count and each get
a row; an empty table gives no rows; other columns are not looked at.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import stored, table, texts

BUCKETS = 16_384
THRESHOLD = -80_000  # millionths of a nat a feature; with 65,536 buckets the trusted texts of sf0.1 lay above -40,000
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"  # fixed value
MIN_WORDS = 50


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _words(text: str = "text") -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _codes(words: Column) -> Column:
    return F.transform(words, lambda w: F.crc32(w))


def _own(code: Column, buckets: int) -> Column:
    return (code % buckets).cast("int")


def _pair(before: Column, code: Column, buckets: int) -> Column:
    """The bucket of two neighbouring words, from their codes."""
    return ((31 * before + code) % buckets).cast("int")


def bucket_counts(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, raw, target``: the features of all texts and of the trusted ones."""
    trusted = (labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
               .agg(F.min(F.coalesce("quality", F.lit(0))).alias("good")).filter("good = 1 and doc_id is not null"))
    marked = texts(docs).join(trusted.hint("shuffle_hash"), "doc_id", "left")  # texts are not sorted
    found = _let(_codes(_words()), lambda codes: F.concat(
        F.transform(codes, lambda code: _own(code, buckets)),
        F.transform(F.slice(codes, 2, F.size(codes)), lambda code, i: _pair(F.get(codes, i), code, buckets))))
    return (marked.select("good", F.explode(found).alias("bucket"))
            .groupBy("bucket").agg(F.count("*").alias("raw"), F.count("good").alias("target")))


def bucket_weights(counts: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The log ratio of each bucket in millionths; all zero without a trusted word."""
    counts = stored(counts, "buckets")
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).first()
    if not total.target:
        return [0] * buckets
    every = counts.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")

    def part(name: str, total: int) -> Column:
        return F.log((F.coalesce(name, F.lit(0)) + 1) / F.lit(float(total + buckets)))

    ratio = F.round((part("target", total.target) - part("raw", total.raw)) * 1e6).cast("long")
    return [r.ratio for r in every.select("bucket", ratio.alias("ratio")).orderBy("bucket").collect()]


def _repeated(words: Column) -> Column:
    """How many words lie in windows of three words that the text holds twice or more.

    Where all window hashes differ there are none; else the windows are sorted by hash and
    compared word by word with their neighbours, and the places of the repeated ones joined.
    """
    starts = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))

    def same(x: Column, y: Column) -> Column:
        return x.h.eqNullSafe(y.h) & (F.slice(words, x.i + 1, 3) == F.slice(words, y.i + 1, 3))

    def covered(windows: Column) -> Column:
        twice = F.filter(windows, lambda x, j: same(x, F.get(windows, j - 1)) | same(x, F.get(windows, j + 1)))
        places = F.sort_array(F.transform(twice, lambda x: x.i))
        none = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(places, none, lambda sum_, i: F.struct(
            (sum_.n + F.least(F.lit(3), i - sum_["last"])).alias("n"), i.alias("last"))).n

    def counted(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_let(placed, covered))

    hashes = F.transform(starts, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return _let(hashes, counted).cast("long")


def judged(docs: DataFrame, weights: list[int], threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: the base measures, ``n_features``, ``log_ratio`` (the sum of
    the ratios in millionths) and whether it is kept."""
    ratios = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<long>")  # one folded constant
    rows = texts(docs)

    buckets = len(weights)

    def scored(codes: Column) -> Column:
        none = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("long").alias("before"))
        return F.aggregate(codes, none, lambda done, code: F.struct(
            (done["sum"] + F.get(ratios, _own(code, buckets))
             + F.coalesce(F.get(ratios, _pair(done.before, code, buckets)), F.lit(0))).alias("sum"), code.alias("before")))["sum"]

    def measures(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), _repeated(words).alias("n_repeat_words"),
                        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                        scored(_codes(words)).alias("log_ratio"))

    bare = F.col("text")
    for symbol in SYMBOLS:
        bare = F.replace(bare, F.lit(symbol), F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id", _let(_words(), measures).alias("m"),
        (F.length("text") - F.length(bare)).cast("long").alias("n_symbols"),
        _let(lines, lambda some: F.size(some) - F.size(F.array_distinct(some))).cast("long").alias("n_dup_lines"))
    rows = rows.select("doc_id", "m.n_words", "m.word_chars", "n_symbols", "n_dup_lines", "m.n_repeat_words", "m.log_ratio",
                       F.greatest(2 * F.col("m.n_words") - 1, F.lit(0)).cast("long").alias("n_features"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    kept = ~failed & (F.col("log_ratio") >= threshold * F.col("n_features"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), kept.alias("kept"), "n_features", "log_ratio")


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` judged by the base rules and the ratio learnt from all of them."""
    return judged(docs, bucket_weights(bucket_counts(docs, labels, buckets), buckets), threshold)


def rules_query(spark, sf_dir):
    """op12: every document of ``documents``, judged."""
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# CRC-32 as SQL: eight shifts for every byte of every distinct word.
RULES_SQL = f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda w: regexp_matches(w, '[^\\x20\\x09-\\x0D]')) AS lines FROM rows),
places AS (SELECT r, doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split),
vocabulary AS (SELECT word, hex(encode(word)) AS raw FROM (SELECT DISTINCT word FROM places)),
codes AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(raw) // 2),
    lambda i: (16 * (instr('0123456789ABCDEF', raw[2 * i + 1]) - 1) + instr('0123456789ABCDEF', raw[2 * i + 2]) - 1)::BIGINT)),
    lambda c, b: xor(c >> 8, list_reduce(list_prepend(xor(c, b) & 255, range(8)),
        lambda x, ignored: xor(x >> 1, 3988292384 * (x & 1)))))) AS code FROM vocabulary),
coded AS (SELECT r, doc_id, i, word, code, lag(code) OVER text AS before, lead(word) OVER text AS next,
    lead(word, 2) OVER text AS third FROM places JOIN codes USING (word) WINDOW text AS (PARTITION BY r ORDER BY i)),
features AS (SELECT r, doc_id, code % {BUCKETS} AS bucket FROM coded
    UNION ALL SELECT r, doc_id, (31 * before + code) % {BUCKETS} FROM coded WHERE i > 1),
trusted AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(coalesce(quality, 0)) = 1),
counts AS (SELECT bucket, count(*) AS raw, count(*) FILTER (WHERE doc_id IN (FROM trusted)) AS target
    FROM features GROUP BY bucket),
totals AS (SELECT sum(raw)::DOUBLE AS raws, sum(target)::DOUBLE AS targets FROM counts),
ratios AS (SELECT bucket, CASE WHEN targets > 0 THEN round((ln((target + 1) / (targets + {BUCKETS}))
    - ln((raw + 1) / (raws + {BUCKETS}))) * 1e6)::BIGINT ELSE 0 END AS ratio FROM counts, totals),
scores AS (SELECT r, sum(ratio)::BIGINT AS log_ratio FROM features JOIN ratios USING (bucket) GROUP BY r),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, word, next, third) AS n FROM coded WHERE third IS NOT NULL),
repeats AS (SELECT r, count(DISTINCT j)::BIGINT AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE n > 1) GROUP BY r),
measured AS (SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
    (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    greatest(2 * len(words) - 1, 0)::BIGINT AS n_features, coalesce(log_ratio, 0) AS log_ratio
    FROM split LEFT JOIN scores USING (r) LEFT JOIN repeats USING (r))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT base_failed AND log_ratio >= {THRESHOLD} * n_features AS kept FROM measured
"""
