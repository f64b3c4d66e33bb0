"""Document fingerprints by consistent weighted sampling.

A text is its words with their counts. Counts are whole numbers, so the weight of a word is divided
into steps, one for each time it occurs: step 1, step 2 and so on up to its count. Each of ``SAMPLES``
samples orders all words and steps there can be by a hash and keeps the least one of a text. That is
uniform over the weight of the text, and consistent: a text that gains or loses other weight keeps it.
Two texts keep the same one with a probability equal to their generalised Jaccard similarity, so the
share of equal samples estimates it.

The next document of each one is found in chunks of the order of ids and texts: borders are pairs of
an id and a text's hash, so an id that many rows share is divided too, and copies of one row that
would fill a chunk are counted before the shuffle. A chunk is ordered in one task, and only the first
document of each chunk crosses a border. Texts are shuffled once, by chunk, and everything up to the
fingerprint follows in that layout. The steps of a word that a text and its edited form share are
sampled once for both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import checkpointed

SAMPLES = 64
CHUNK_ROWS = 2048
# Beyond it chunks grow, but there are always several to a shuffle partition.
MOST_CHUNKS = 16_384
CHUNKS_OF_PARTITION = 4
# Copies of one row that a task writes.
COPIES = 65_536
# Hex digits that name a sample: unlike ones look alike once in 65,536 cases.
DIGITS = 4

_SPACE = r"[\x20\x09-\x0D]+"
# Odd, so its multiples are different for each sample.
_STRIDE = 0x9E3779B97F4A7C15


def _sample(k: int) -> Column:
    """Sample k of a word's step ``e``: the whole number orders, its last bits name the word and the step."""
    salt = (k + 1) * _STRIDE % (1 << 64)
    return F.xxhash64(F.col("e").bitwiseXOR(F.lit(salt - (1 << 64) if salt >> 63 else salt)))


def _words(text: str, side: int) -> Column:
    """A hash of each word of a text, whose last bit tells the side."""
    words = F.filter(F.split(F.lower(F.col(text)), _SPACE), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit(-2)).bitwiseOR(F.lit(side)))


def _steps(rows: DataFrame) -> DataFrame:
    """rows with a sorted array ``a``, and a row per word and step with a hash ``e`` of both and ``side``.

    Steps that both sides have are rows of side 2. Without words there is one row of NULLs.
    """
    last = F.size("a") - 1
    starts = F.filter(
        F.when(last >= 0, F.sequence(F.lit(0), last)),
        lambda i: (i == 0) | (F.get("a", i) != F.get("a", i - 1)),
    )
    rows = rows.withColumn("starts", starts)
    run = F.transform(
        "starts",
        lambda s, j: F.struct(
            F.get("a", s).alias("v"),
            (F.coalesce(F.get("starts", j + 1), F.size("a")) - s).alias("n"),
        ),
    )
    rows = rows.withColumn("runs", run).drop("a", "starts")

    def count_of(word: Column, run: Column) -> Column:
        """The count of the neighbouring run where it is the other side of the same word, else 0."""
        return F.when(run["v"].bitwiseXOR(word) == 1, run["n"]).otherwise(0)

    def placed(run: Column, j: Column) -> Column:
        side = run["v"].bitwiseAND(F.lit(1)).cast("int")
        before, after = count_of(run["v"], F.get("runs", j - 1)), count_of(run["v"], F.get("runs", j + 1))
        shared = F.least(run["n"], F.when(side == 0, after).otherwise(before))
        word = run["v"].bitwiseAND(F.lit(-2)).alias("h")

        def part(low: Column, high: Column, side: Column) -> Column:
            return F.struct(word, low.alias("low"), high.alias("high"), side.alias("side"))

        # The first side writes the shared steps as well.
        shared_part = part(F.lit(1), F.when(side == 0, shared).otherwise(0), F.lit(2))
        return F.array(shared_part, part(shared + 1, run["n"], side))

    parts = F.filter(F.flatten(F.transform("runs", placed)), lambda x: x["low"] <= x["high"])
    kept = [F.col(c) for c in rows.columns if c != "runs"]
    rows = rows.select(*kept, F.inline_outer(parts))
    rows = rows.withColumn("step", F.explode_outer(F.sequence("low", "high")))
    return rows.withColumn("e", F.xxhash64("h", "step")).drop("h", "low", "high", "step")


def fingerprints(rows: DataFrame, keys: list[str], texts: dict[str, str]) -> DataFrame:
    """Fingerprints of one or two texts of each row of ``keys``, which identify a row.

    ``texts`` maps the name of a fingerprint to the column of its text. It is empty for a text without
    words. Where rows already lie together by one of the keys, nothing is shuffled.
    """
    none = F.array().cast("array<bigint>")
    words = F.concat(*[F.coalesce(_words(text, side), none) for side, text in enumerate(texts.values())])
    samples = [F.min(_sample(k)).alias(f"s{k}") for k in range(SAMPLES)]
    steps = _steps(rows.select(*keys, F.sort_array(words).alias("a")))
    signed = steps.groupBy(*keys, "side").agg(*samples)
    # At most three rows of a key: a step of both sides counts for each. Without words the side is NULL.
    least = [
        F.min(F.when(F.col("side") != 1 - side, F.col(f"s{k}"))).alias(f"s{side}_{k}")
        for side in range(len(texts))
        for k in range(SAMPLES)
    ]
    signed = signed.groupBy(*keys).agg(*least)
    names = F.lit((1 << 4 * DIGITS) - 1)

    def joined(side: int) -> Column:
        parts = [F.lpad(F.hex(F.col(f"s{side}_{k}").bitwiseAND(names)), DIGITS, "0") for k in range(SAMPLES)]
        return F.coalesce(F.concat(*parts), F.lit(""))

    return signed.select(*keys, *[joined(side).alias(name) for side, name in enumerate(texts)])


def likeness(one: str, other: str) -> Column:
    """Share of equal samples; two empty fingerprints are alike, an empty and another one are not."""
    equal = sum(
        (F.substring(one, DIGITS * k + 1, DIGITS) == F.substring(other, DIGITS * k + 1, DIGITS)).cast("int")
        for k in range(SAMPLES)
    )
    either_empty = (F.col(one) == "") | (F.col(other) == "")
    return F.when(either_empty, (F.col(one) == F.col(other)).cast("double")).otherwise(equal / F.lit(float(SAMPLES)))


def _key() -> Column:
    """What rows are ordered by: the id, rows without one first, then the text."""
    return F.struct(
        F.col("doc_id").isNotNull().alias("known"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.xxhash64("text").alias("hash"),
    )


def _chunk(key: Column, borders: list[tuple]) -> Column:
    """Number of borders at or below the key, looked up by blocks."""
    if not borders:
        return F.lit(0)
    block = max(1, int(len(borders) ** 0.5))

    def listed(some: list[tuple]) -> Column:
        # All literals, so the optimizer makes one of them.
        keys = (f"named_struct('known', {bool(k)}, 'id', {i}L, 'hash', {h}L)" for k, i, h in some)
        return F.expr(f"array({', '.join(keys)})")

    full = F.lit(0)
    ends = borders[block - 1 :: block]
    if ends:
        full = F.size(F.filter(listed(ends), lambda e: e <= key)) * block
    rest = F.size(F.filter(F.slice(listed(borders), full + 1, block), lambda e: e <= key))
    return full + rest


def _borders(rows: DataFrame) -> tuple[list[tuple], list[tuple]]:
    """Borders that divide rows into about even chunks, and keys with enough copies to fill one.

    Both are at most as many as chunks.
    """
    count = rows.count()
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = min(max(MOST_CHUNKS, CHUNKS_OF_PARTITION * partitions), -(-count // CHUNK_ROWS))
    if chunks < 2:
        return [], []
    keys = rows.select(F.inline(F.array(_key()))).repartitionByRange(chunks, "known", "id", "hash")
    # Ranges keep equal keys together: nothing is shuffled to count them.
    counted = keys.groupBy("known", "id", "hash").agg(F.count(F.lit(1)).alias("n"))
    key = F.struct("known", "id", "hash")
    copies = F.col("n") > F.lit(max(CHUNK_ROWS, -(-count // chunks)))
    ranges = counted.groupBy(F.spark_partition_id().alias("range")).agg(
        F.min(key).alias("first"), F.collect_list(F.when(copies, key)).alias("hot")
    )
    found = ranges.collect()
    borders = sorted(tuple(row["first"]) for row in found)[1:]
    return borders, sorted(tuple(h) for row in found for h in row["hot"])


def in_chunks(docs: DataFrame) -> tuple[DataFrame, bool]:
    """doc_id and text with ``chunk`` and ``copies``, and whether any row stands for several.

    The order is by id, rows without one first; rows with equal ids are ordered by their text. A row of
    which there is more than a chunk stands twice: once for all copies but the last, once for the last.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    borders, hot = _borders(rows)
    one = F.lit(1).cast("long").alias("copies")
    if hot:
        keys = F.broadcast(rows.sparkSession.createDataFrame(hot, "known boolean, id long, hash long"))
        keyed = rows.select("*", F.inline(F.array(_key())))
        on = ["known", "id", "hash"]
        counted = keyed.join(keys, on, "left_semi").groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
        parts = F.when(F.col("copies") > 1, F.array(F.col("copies") - 1, one)).otherwise(F.array(one))
        counted = counted.select("doc_id", "text", F.explode(parts).alias("copies"))
        rows = keyed.join(keys, on, "left_anti").select("doc_id", "text", one).unionByName(counted)
    else:
        rows = rows.select("*", one)
    return rows.withColumn("chunk", _chunk(_key(), borders).cast("int")), bool(hot)


def _all_copies(result: DataFrame) -> DataFrame:
    """Each row as often as ``copies`` says, no more than ``COPIES`` of one in a task."""
    parts = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))
    several = result.filter("copies > 1").withColumn("part", F.explode(parts))
    several = several.repartition("doc_id", "edited_sha256", "part")
    here = F.least(F.col("copies") - F.col("part"), F.lit(COPIES)).cast("int")
    several = several.withColumn("part", F.explode(F.sequence(F.lit(1), here))).drop("part")
    return result.filter("copies = 1").unionByName(several).drop("copies")


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of docs, of its edited text, and how alike they are.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The
    edited text ends with the beginning of the next document's. A NULL text counts as empty; repeated
    rows follow each other; an empty table gives no rows; further columns are left out.
    """
    rows, hot = in_chunks(docs)
    spark = docs.sparkSession
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("copies").desc()]
    first = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_hash"))
    opening = checkpointed(rows.groupBy("chunk").agg(F.min_by("text", first).alias("opening")))
    # One row per chunk: as many as borders, and one.
    used = sorted(row[0] for row in opening.select("chunk").collect())
    following = spark.createDataFrame(list(zip(used, used[1:] + used[:1])), "before int, chunk int")
    opening = opening.join(F.broadcast(following), "chunk").select(F.col("before").alias("chunk"), "opening")
    inside = Window.partitionBy("chunk").orderBy(*order)
    rows = rows.withColumns({"rn": F.row_number().over(inside), "next": F.lead("text").over(inside)})
    rows = rows.join(opening, "chunk").withColumn("next", F.coalesce("next", "opening"))
    size = F.length("text")
    tail = F.floor(size / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), size - tail), F.substr("next", F.lit(1), tail))
    rows = rows.withColumn("edited", edited)
    sha = F.unhex(F.sha2("edited", 256)).alias("sha")
    rows = rows.select("chunk", "rn", "doc_id", "copies", size.cast("long").alias("n_chars"), sha, "text", "edited")
    keys = ["chunk", "rn", "doc_id", "copies", "n_chars", "sha"]
    names = {"fingerprint": "text", "edited_fingerprint": "edited"}
    own = checkpointed(fingerprints(rows, keys, names))

    openings = own.filter("rn = 1").select("chunk", F.col("fingerprint").alias("opening"))
    openings = openings.join(F.broadcast(following), "chunk").select(F.col("before").alias("chunk"), "opening")
    inside = Window.partitionBy("chunk").orderBy("rn")
    own = own.withColumn("next_fingerprint", F.lead("fingerprint").over(inside))
    all_rows = own.join(F.broadcast(openings), "chunk")
    all_rows = all_rows.withColumn("next_fingerprint", F.coalesce("next_fingerprint", "opening"))
    result = all_rows.select(
        "doc_id",
        "copies",
        "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
    return _all_copies(result) if hot else result.drop("copies")
