"""Personal data in texts: four base kinds by pattern, and further identifiers by bootstrapped context.

Base spans are what the four base patterns find. They are the seeds of the second part. What stands before
an identifier in its line is its contexts: the word before it, and the two words before it or, where there is
one only, that word as the beginning of the line. A context that mostly precedes known identifiers becomes a
pattern, what follows good patterns becomes a known identifier, and so on over the graph of contexts and
identifiers until nothing changes. Contexts are scored against all their occurrences in the corpus, so words
that also stand before ordinary words never become a pattern. A candidate is a run of words that
each have a digit or an @, such as a number that is written in groups.

Only built-in expressions are used. Positions come from the lengths of what lies between the
matches. Texts are scanned once for spans and mentions and once for the occurrences of contexts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.session import checkpointed

KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"

# These find what the base patterns find, without going back inside a run of equal characters.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A word with a digit or an @ is identifier-like; with nothing but blanks between them, several are one run.
_WORD = r"[^\s0-9@]*+[0-9@]\S*+"
RUN = rf"(?<!\S){_WORD}(?:(?<![,;:!?.])[ \t]++{_WORD})*+"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

LINE_START = "\n"  # stands for the word before the first of a line
LEAST_VALUES = 3  # distinct known identifiers that make a context a pattern
LEAST_SCORE = 0.7  # of a pattern, and of a token that it makes known
COUNTED_FIRST = (64, 8)  # parts of the documents, in which occurrences are counted first
BROADCAST_CONTEXTS = 200_000
BROADCAST_SPANS = 20_000

_BLOCK = 256


def _running(lengths: str) -> str:
    """SQL for the running sums of an array of numbers, in blocks so that long arrays stay cheap."""
    blocks = f"transform(sequence(0, (size({lengths}) - 1) div {_BLOCK}), b -> slice({lengths}, b * {_BLOCK} + 1, {_BLOCK}))"
    sums = f"transform({blocks}, x -> aggregate(x, 0, (a, v) -> a + v))"
    starts = f"aggregate({sums}, array(0), (a, v) -> concat(a, array(element_at(a, -1) + v)))"
    inner = "aggregate(x.x, array(x.s), (a, v) -> concat(a, array(element_at(a, -1) + v)))"
    paired = f"zip_with({blocks}, slice({starts}, 1, size({blocks})), (x, s) -> named_struct('x', x, 's', s))"
    return f"flatten(transform({paired}, x -> slice({inner}, 2, {_BLOCK})))"


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    return F.lit(True)


def _luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled, less 9 if above 9; the sum ends in 0."""

    def worth(place: Column) -> Column:
        digit = F.substr(digits, -place, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when(place % 2 == 0, twice).otherwise(digit)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), lambda total, place: total + worth(place)) % 10 == 0


def _spans(rows: DataFrame, kind: str, place: int) -> DataFrame:
    """rows with ``kind``: the valid spans of a kind, as structs of start, place, kind and end."""
    hits, gaps, ends = f"__hits_{kind}", f"__gaps_{kind}", f"__ends_{kind}"
    some = F.exists(hits, lambda hit: _valid(kind, hit))
    rows = rows.withColumn(hits, F.regexp_extract_all("__text", F.lit(BASE[kind]), F.lit(0)))
    rows = rows.withColumn(gaps, F.when(some, F.split("__text", BASE[kind], -1)))
    lengths = F.transform(hits, lambda hit, i: F.length(hit) + F.length(F.get(gaps, i)))
    rows = rows.withColumn(ends, F.when(F.col(gaps).isNotNull(), lengths))
    rows = rows.withColumn(ends, F.when(F.col(gaps).isNotNull(), F.expr(_running(ends))))
    span = F.transform(
        hits,
        lambda hit, i: F.struct(
            (F.get(ends, i) - F.length(hit)).alias("start"),
            F.lit(place).alias("place"),
            F.lit(kind).alias("kind"),
            F.get(ends, i).alias("end"),
            _valid(kind, hit).alias("valid"),
        ),
    )
    kept = F.transform(F.filter(span, lambda s: s["valid"]), lambda s: s.dropFields("valid"))
    empty = F.expr("cast(array() as array<struct<start: int, place: int, kind: string, end: int>>)")
    return rows.withColumn(kind, F.when(F.col(gaps).isNotNull(), kept).otherwise(empty)).drop(
        hits, gaps, ends
    )


def base_spans(rows: DataFrame) -> DataFrame:
    """rows, which have a ``__text``, with ``base``: all base spans by start, then kind as listed."""
    for place, kind in enumerate(KINDS):
        rows = _spans(rows, kind, place)
    return rows.withColumn("base", F.array_sort(F.concat(*KINDS)))


def _mentions(rows: DataFrame) -> DataFrame:
    """rows with ``mentions``: the runs of identifier-like words with their contexts.

    A run stands without punctuation around it. ``known`` tells whether a base span touches it; its value is
    then that of the first such span, and it has contexts only if the span begins where the run does.
    """
    hits, gaps, ends = "__hits", "__gaps", "__ends"
    rows = rows.withColumn(hits, F.regexp_extract_all("__text", F.lit(RUN), F.lit(0)))
    some = F.size(hits) > 0
    rows = rows.withColumn(gaps, F.when(some, F.split("__text", RUN, -1)))
    lengths = F.transform(hits, lambda hit, i: F.length(hit) + F.length(F.get(gaps, i)))
    rows = rows.withColumn(ends, F.when(some, lengths))
    rows = rows.withColumn(ends, F.when(some, F.expr(_running(ends))))

    # Step by step, because what a lambda names twice is computed twice.
    def bare(hit: Column, i: Column) -> Column:
        gap = F.get(gaps, i)
        opened = F.ltrim(hit, F.lit("([{<\"'"))
        line = F.regexp_replace(F.substring_index(gap, "\n", -1), "[ \t]+", " ")
        return F.struct(
            hit.alias("hit"),
            (F.get(ends, i) - F.length(opened)).alias("start"),
            (F.get(ends, i) - F.length(hit)).alias("hit_start"),
            F.rtrim(opened, F.lit(".,;:!?)]}>\"'")).alias("value"),
            F.when(line.endswith(" "), F.nullif(F.lower(F.trim(line)), F.lit(""))).alias("words"),
            ((i == 0) | gap.contains("\n")).alias("opens_line"),
        )

    def seeded(m: Column) -> Column:
        end = m["start"] + F.length(m["value"])
        one, two = F.substring_index(m["words"], " ", -1), F.substring_index(m["words"], " ", -2)
        longer = F.when(m["words"].contains(" "), two).when(m["opens_line"], F.concat(F.lit(f"{LINE_START} "), one))
        touches = F.filter("base", lambda s: (s["start"] < end) & (s["end"] > m["start"]))
        return F.struct(
            m.alias("m"), end.alias("end"), F.get(touches, F.lit(0)).alias("seed"), F.array_compact(F.array(one, longer)).alias("c")
        )

    def mention(x: Column) -> Column:
        m, seed = x["m"], x["seed"]
        begins, known = seed["start"] <= m["start"], seed.isNotNull()
        own = F.substr(m["hit"], seed["start"] - m["hit_start"] + 1, seed["end"] - seed["start"])
        return F.struct(
            m["start"].alias("start"),
            x["end"].alias("end"),
            F.lower(F.when(known & begins, own).otherwise(m["value"])).alias("value"),
            F.when(m["words"].isNotNull() & (~known | begins), x["c"]).alias("contexts"),
            known.alias("known"),
        )

    found = F.transform(F.transform(F.transform(hits, bare), seeded), mention)
    return rows.withColumn("mentions", F.when(some, found)).drop(hits, gaps, ends)


def _scanned(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, base spans and mentions of each row, without its text."""
    rows = docs.select(
        F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text")
    )
    rows = rows.withColumn("text_hash", F.xxhash64("__text"))
    return _mentions(base_spans(rows)).select("doc_id", "text_hash", "base", "mentions")


def _occurrences(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """context and ``total``, how often its words stand in a line of any text."""
    if contexts.count() <= BROADCAST_CONTEXTS:
        contexts = F.broadcast(contexts)
    lines = docs.select(F.explode(F.split(F.lower(F.col("text").cast("string")), "\n")).alias("line"))
    words = lines.select(F.split(F.trim(F.col("line"), F.lit(" \t")), "[ \t]+").alias("w"))
    before = F.expr(f"concat(array('{LINE_START}'), w)")
    words = words.select(F.inline(F.arrays_zip(before.alias("before"), F.col("w").alias("word"))))
    words = words.filter("word IS NOT NULL")
    both = F.explode(F.array(F.col("word"), F.concat_ws(" ", "before", "word"))).alias("context")
    return words.select(both).join(contexts, "context", "left_semi").groupBy("context").agg(F.count(F.lit(1)).alias("total"))


def learned(docs: DataFrame, mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Patterns (context) and identifiers (value) that the seeds lead to.

    ``mentions`` has a row per mention: context, value and known.
    """
    spark = mentions.sparkSession
    none = spark.createDataFrame([], "context string"), spark.createDataFrame([], "value string")
    edges = mentions.filter("context IS NOT NULL").groupBy("context", "value")
    edges = edges.agg(F.count(F.lit(1)).alias("n"), F.max(F.col("known").cast("double")).alias("seed"))
    usual = edges.groupBy("context").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("mentions"))
    usual = checkpointed(usual.filter(F.col("values") >= LEAST_VALUES).select("context", "mentions"))
    # Where a part of the documents already has too many occurrences for a context to reach the least
    # score, the rest cannot change that: common words go before all documents are counted.
    for part in COUNTED_FIRST:
        if usual.isEmpty():
            return none
        some = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(part)) == 0)
        seen = usual.join(_occurrences(some, usual.select("context")), "context", "left")
        most = F.col("mentions") / (F.coalesce("total", F.lit(0)) + 1)
        usual = checkpointed(seen.filter(most >= LEAST_SCORE).select("context", "mentions"))
    if usual.isEmpty():
        return none
    graph = edges.join(_occurrences(docs, usual.select("context")), "context")
    graph = checkpointed(graph.select("context", "value", "n", "total", "seed"))
    scored, before = graph.withColumn("score", F.col("seed")), None
    patterns = None
    # What is known stays known, so the rounds come to an end.
    while True:
        support = F.count(F.when(F.col("score") >= LEAST_SCORE, 1))
        patterns = (
            scored.groupBy("context")
            .agg(
                (F.sum(F.col("n") * F.col("score")) / (F.max("total") + 1)).alias("p"),
                support.alias("support"),
            )
            .filter((F.col("support") >= LEAST_VALUES) & (F.col("p") >= LEAST_SCORE))
        )
        patterns = checkpointed(patterns.select("context", "p"))
        doubt = F.exp(F.sum(F.log(1 - F.least("p", F.lit(0.999)))))
        likely = graph.join(patterns, "context").groupBy("value").agg((1 - doubt).alias("likely"))
        score = F.greatest("seed", (F.coalesce("likely", F.lit(0.0)) >= LEAST_SCORE).cast("double"))
        scored = checkpointed(
            graph.join(likely, "value", "left").select("context", "value", "n", "total", "seed", score.alias("score"))
        )
        now = scored.agg(F.sum("score")).first()[0]
        if now == before:
            break
        before = now
    values = scored.filter((F.col("score") >= LEAST_SCORE) & (F.col("seed") < 1))
    # A short token is too common to be known wherever it stands.
    values = values.filter(F.length("value") >= 6).select("value").distinct()
    return patterns.select("context"), values


def _further(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """Spans by context that touch no base span, as ``further``, per doc_id and text_hash."""
    rows = scanned.select("doc_id", "text_hash", F.inline("mentions"))
    rows = rows.withColumn("context", F.explode_outer("contexts")).drop("contexts")
    patterns, values = learned(docs, rows)
    rows = rows.filter("NOT known AND length(value) > 0")
    found = rows.join(patterns, "context", "left_semi").select("doc_id", "text_hash", "start", "end")
    found = found.union(rows.join(values, "value", "left_semi").select("doc_id", "text_hash", "start", "end"))
    span = F.struct("start", F.lit(len(KINDS)).alias("place"), F.lit(CONTEXT).alias("kind"), "end")
    # The spans of one text.
    return (
        found.distinct()
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_list(span)).alias("further"))
        .withColumnsRenamed({"doc_id": "__doc_id", "text_hash": "__text_hash"})
    )


def _with_further(rows: DataFrame, further: DataFrame) -> DataFrame:
    """rows with ``spans``: base and further spans by start, then kind."""
    same = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("text_hash") == F.col("__text_hash"))
    joined = rows.join(further, same, "left")
    none = F.expr("cast(array() as array<struct<start: int, place: int, kind: string, end: int>>)")
    spans = F.array_sort(F.concat("base", F.coalesce("further", none)))
    return joined.withColumn("spans", spans).drop("__doc_id", "__text_hash", "further")


def _written(spans: str) -> Column:
    """kind:start:end, joined by commas."""
    texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def found(docs: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each base kind, base_sha256 and all spans of every row.

    Positions are code points, the end is exclusive. A NULL text counts as empty; rows with equal or
    NULL ids are rows of their own; columns other than doc_id and text are left out.
    """
    scanned = checkpointed(_scanned(docs))
    rows = _with_further(scanned.drop("mentions"), _further(docs, scanned))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *map(number, KINDS),
        F.sha2(_written("base"), 256).alias("base_sha256"),
        _written("spans").alias("spans"),
    )


# Spans that overlap become one, of the kind of the first.
_MERGED = """
aggregate(spans, cast(array() as array<struct<start: int, kind: string, end: int>>), (done, s) ->
  if(s.start < try_element_at(done, -1).end,
     concat(slice(done, 1, size(done) - 1),
            array(named_struct('start', try_element_at(done, -1).start, 'kind', try_element_at(done, -1).kind,
                               'end', greatest(try_element_at(done, -1).end, s.end)))),
     concat(done, array(named_struct('start', s.start, 'kind', s.kind, 'end', s.end)))))
"""
# What stands before each span, then its kind; after the last one, the rest.
_REPLACED = """
concat(
  array_join(transform(spans, (s, i) -> concat(
    substring(__text, if(i = 0, 0, get(spans, i - 1).end) + 1, s.start - if(i = 0, 0, get(spans, i - 1).end)),
    '[', upper(s.kind), ']')), ''),
  substring(__text, element_at(spans, -1).end + 1))
"""


def redacted(docs: DataFrame) -> DataFrame:
    """All rows and columns of docs, with every span of its text replaced by its kind in brackets.

    ``n_chars`` is counted anew where a text changes. Spans that overlap are replaced as one.
    """
    further = checkpointed(_further(docs, checkpointed(_scanned(docs))))
    if (further.agg(F.sum(F.size("further"))).first()[0] or 0) <= BROADCAST_SPANS:
        further = F.broadcast(further)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("row"), "doc_id", text.alias("__text"), F.xxhash64(text).alias("text_hash"))
    rows = _with_further(base_spans(rows), further).withColumn("spans", F.expr(_MERGED))
    some = F.size("spans") > 0
    rows = rows.withColumn("clean", F.when(some, F.expr(_REPLACED)))
    columns = []
    for name in docs.columns:
        value = F.col("row")[name]
        if name == "text":
            value = F.when(some, F.col("clean")).otherwise(value)
        elif name == "n_chars":
            kind = docs.schema[name].dataType
            value = F.when(some, F.length("clean").cast(kind)).otherwise(value)
        columns.append(value.alias(name))
    return rows.select(*columns)
