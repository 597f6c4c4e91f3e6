"""Operator 1, document fingerprints by winnowing, with built-in functions only.

A text's units are its words.  Each unit is hashed once, and every run of ``K`` units gets the cyclic polynomial of its hashes
(each rotated by a bit for every unit after it, all combined by exclusive or), a rolling hash of 64 bits; of each window of ``w``
consecutive hashes the least is chosen, by its first 31 bits, the rightmost among equal ones, and the chosen hashes keep their
positions and all their bits.  The 31 bits and the position are packed in one number whose order is (bits, later position first), so the
choice is a plain minimum, and the minimum of a window of 1, 2, 4, 8, 16 hashes is made by doubling.  ``w`` is 16 for texts
of 128 hashes or more and smaller for shorter ones, so that these have some fingerprints too.

Guarantee: two texts of that length that share a run of ``w + K - 1`` words share a chosen hash, wherever it stands.

Texts of up to ``SHORT`` code points are too small for words alone and carry a second part made of their characters; a
rule of each text by itself, the same whatever the table's size.  All columns of a row are in memory at once, some 20 times
the bytes of the largest single text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from silverbrook.llm.storage import partitions

K, LEVELS, SHORT, SHORT_K = 3, 4, 320, 5
SPACE = r"[\x20\x09-\x0D]+"
#: Rows of a bucket of neighbours, and bucket heads that may be broadcast (their ids take some 3 MB).
BUCKET, HEADS = 256, 100_000
#: Stretches of doc_id with equal numbers of rows, from approximate quantiles; each is cut evenly into buckets.
STRETCHES, ACCURACY = 256, 25_600

_LOW = (1 << 32) - 1


def _grams(hashes: Column, k: int) -> Column:
    """The hash of the k-gram from each unit on; the last k - 1 are of shorter grams."""

    def gram(first: Column, i: Column) -> Column:
        value = first
        for j in range(1, k):
            turned = F.shiftleft(value, 1).bitwiseOR(F.shiftrightunsigned(value, 63))
            value = turned.bitwiseXOR(F.coalesce(F.get(hashes, i + j), F.lit(0).cast("long")))
        return value

    return F.transform(hashes, gram)


def _packed(grams: Column) -> Column:
    """(the first 31 bits of a hash, descending position) as one long."""
    return F.transform(grams, lambda v, i: F.shiftleft(F.shiftrightunsigned(v, 33), 32) + (F.lit(_LOW) - i))


def _chosen(df: DataFrame, units: str, k: int, out: str) -> DataFrame:
    """Add the chosen hashes with their positions; each step is a column of its own, so that none is evaluated more than once."""
    n = F.size(units)
    grams, full = f"{out}_0", f"{out}_all"
    df = df.withColumn(f"{out}_hash", F.transform(units, lambda x: F.xxhash64(x)))
    df = df.withColumn(full, _grams(F.col(f"{out}_hash"), k))
    df = df.withColumn(full, F.when(n >= k, F.slice(full, F.lit(1), n - (k - 1))).otherwise(F.slice(full, 1, 1)))
    df = df.withColumn(grams, _packed(F.col(full)))
    now = grams
    for level in range(1, LEVELS + 1):
        half, name = 1 << (level - 1), f"{out}_{level}"
        rest = F.greatest(F.size(now) - half, F.lit(0))
        both = F.zip_with(F.slice(now, F.lit(1), rest), F.slice(now, F.lit(half + 1), rest), lambda x, y: F.least(x, y))
        df = df.withColumn(name, F.when(F.size(grams) >= 8 << level, both).otherwise(F.col(now)))
        now = name
    place = lambda x: F.lit(_LOW) - x.bitwiseAND(F.lit(_LOW))
    taken = F.transform(F.array_distinct(now), lambda x: F.struct(F.get(F.col(full), place(x).cast("int")).alias("hash"), place(x).alias("at")))
    return df.withColumn(out, taken).drop(f"{out}_hash", full, *[f"{out}_{i}" for i in range(LEVELS + 1)])


def with_fingerprint(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add ``{prefix}words`` and ``{prefix}chars``: arrays of (hash, at), the hashes that are chosen and their positions.

    A null text counts as empty.  A text without words has two empty arrays; ``{prefix}chars`` is null for texts longer
    than ``SHORT``.  A text of fewer than ``K`` words has one gram.  Columns of these names are overwritten.
    """
    clean = f"{prefix}__text"
    df = df.withColumn(clean, F.coalesce(F.col(text).cast("string"), F.lit("")))
    df = df.withColumn(f"{prefix}__units", F.filter(F.split(clean, SPACE), lambda x: x != ""))
    df = _chosen(df, f"{prefix}__units", K, f"{prefix}words")
    short = F.when(F.length(clean) <= SHORT, F.filter(F.split(clean, ""), lambda x: x != ""))
    df = _chosen(df.withColumn(f"{prefix}__units", short), f"{prefix}__units", SHORT_K, f"{prefix}chars")
    return df.drop(clean, f"{prefix}__units")


def _hashes(column: str) -> Column:
    return F.array_distinct(F.col(f"{column}.hash"))


def likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Add the Jaccard index of two fingerprints' hashes: of the characters' if both have them, else of the words'."""
    parts = [(F.col(f"{a}chars").isNotNull() & F.col(f"{b}chars").isNotNull(), "chars"), (None, "words")]
    same = F.lit(None).cast("double")
    for test, part in reversed(parts):
        x, y = f"{a}{part}_h", f"{b}{part}_h"
        both = F.size(F.array_intersect(x, y))
        rate = F.when(F.size(x) + F.size(y) == 0, 1.0).otherwise(both / (F.size(x) + F.size(y) - both))
        same = rate if test is None else F.when(test, rate).otherwise(same)
    return df.withColumn(out, same.cast("double"))


def shown(prefix: str = "") -> Column:
    """A fingerprint as text: hash:position of what was chosen, of the words and then, after a bar, the characters."""
    one = lambda x: F.concat(F.hex(x["hash"]), F.lit(":"), x["at"].cast("string"))
    return F.concat_ws("|", *[F.concat_ws(" ", F.transform(f"{prefix}{part}", one)) for part in ("words", "chars")])


def _bucketed(rows: DataFrame) -> tuple[DataFrame, int]:
    """Add ``bucket``, whose descending order is that of documents, and give the number of rows.

    Stretches of doc_id that quantiles find to hold equal numbers of rows are cut evenly, so neither an id far from the
    others nor ids in clusters fill a bucket.  An id that holds a stretch or more, and the null ids, are dealt by a hash of
    the text, which orders rows of one id."""
    span = rows.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("known"), F.percentile_approx("doc_id", [i / STRETCHES for i in range(STRETCHES + 1)], ACCURACY).alias("at")).first()
    n, at = span["n"], span["at"] or []
    #: (first doc_id, last doc_id, buckets, dealt by hash), ascending
    stretches: list[tuple[int, int, int, bool]] = []
    each = -(-n // (STRETCHES * BUCKET)) or 1
    lows = sorted(set(at))
    for i, low in enumerate(lows):
        times, nxt = at.count(low), lows[i + 1] if i + 1 < len(lows) else None
        if times > 1:
            stretches.append((low, low, each * times, True))
        if nxt is None or low + (times > 1) < nxt:
            stretches.append((low + (times > 1), (nxt or (1 << 63)) - 1, each, False))
    if stretches and stretches[-1][0] > (1 << 63) - 1:
        stretches.pop()
    high_bits = F.shiftright(F.xxhash64("text"), 32) + F.lit(1 << 31)
    hash_part = lambda parts: parts - 1 - F.shiftright(high_bits * parts, 32)
    nulls = max(1, -(-(n - span["known"]) // BUCKET))
    null_bucket = hash_part(F.lit(nulls).cast("long"))
    if not stretches:
        return rows.withColumn("bucket", null_bucket), n
    # written as text, an array is one constant of the plan
    listed = lambda values: F.split(F.lit(",".join(str(int(v)) for v in values)), ",").cast("array<long>")
    column = lambda k: listed([s[k] for s in stretches])
    before, base = [], nulls
    for s in stretches:
        before.append(base)
        base += s[2]
    rows = rows.withColumn("_s", F.greatest(F.lit(1), F.size(F.filter(column(0), lambda x: x <= F.col("doc_id")))))
    pick = lambda values: F.element_at(values, F.col("_s"))
    low, high, parts = (pick(column(k)).cast("decimal(38,0)") for k in (0, 1, 2))
    even = F.floor((F.col("doc_id").cast("decimal(38,0)") - low) * parts / (high - low + 1)).cast("long")
    even = F.least(F.greatest(even, F.lit(0).cast("long")), parts.cast("long") - 1)
    inside = F.when(pick(column(3)) == 1, hash_part(parts.cast("long"))).otherwise(even)
    bucket = pick(listed(before)) + inside
    return rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), null_bucket).otherwise(bucket)).drop("_s"), n


def beside_next(docs: DataFrame) -> DataFrame:
    """Fingerprint each text and put the next document's text and fingerprint beside it.  Runs one job for the quantiles of doc_id.

    Next is the document with the next smaller doc_id, after the last the first; rows with one doc_id follow each other
    by a hash of their text, then by text, and null doc_ids come last.  Documents are dealt to buckets (:func:`_bucketed`);
    the first document of a bucket also visits the next higher bucket that has rows, as a guest, so that no bucket needs
    another's rows.  The highest bucket's first visits the lowest.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows, n = _bucketed(rows)
    rows = rows.withColumn("place", F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"), F.bitwise_not(F.xxhash64("text")).alias("hash")))
    heads = rows.groupBy("bucket").agg(F.max("place").alias("place")).withColumn("group", F.floor(F.col("bucket") / F.lit(HEADS)))
    # the next higher bucket: in the same group of buckets, else the lowest of the next group
    groups = heads.groupBy("group").agg(F.min("bucket").alias("lowest"))
    all_groups = Window.orderBy("group")  # one row for each HEADS buckets
    groups = groups.select("group", F.coalesce(F.lead("lowest").over(all_groups), F.min("lowest").over(Window.partitionBy())).alias("beyond"))
    higher = F.lead("bucket").over(Window.partitionBy("group").orderBy("bucket"))
    guests = heads.withColumn("higher", higher).join(groups, "group").select("place", "bucket", F.coalesce("higher", "beyond").alias("host"))
    if n // BUCKET + 3 * STRETCHES <= HEADS:
        guests = F.broadcast(guests)
    # rows of one place are one text
    guests = rows.join(guests, ["place", "bucket"]).dropDuplicates(["place", "bucket"]).select("doc_id", "text", "place", F.col("host").alias("bucket"), F.lit(1).alias("guest"))
    every = rows.select("doc_id", "text", "place", "bucket", F.lit(0).alias("guest")).unionByName(guests)
    # texts are shuffled without their fingerprints, and these are made in as many tasks as there are shuffle partitions
    every = with_fingerprint(every.repartition(partitions(docs.sparkSession), "bucket"))
    after = Window.partitionBy("bucket").orderBy("guest", F.col("place").desc(), "text")
    for name in ("text", "words", "chars"):
        every = every.withColumn(f"next_{name}", F.lead(name).over(after))
    return every.where("guest = 0").drop("guest", "bucket", "place")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored) its fingerprint and that of its edited text, whose
    last third is the beginning of the next document's, with both likenesses.  An empty table gives no rows; a single
    document is its own next.  Two empty fingerprints are alike."""
    df = beside_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    df = df.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - third), F.substring("next_text", F.lit(1), third)))
    df = with_fingerprint(df, "edited", "edited_")
    for prefix in ("", "next_", "edited_"):
        for part in ("words", "chars"):
            df = df.withColumn(f"{prefix}{part}_h", _hashes(f"{prefix}{part}"))
    df = likeness(likeness(df, "", "edited_", "near_edited"), "", "next_", "near_next")
    return df.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        shown().alias("fingerprint"),
        shown("edited_").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
