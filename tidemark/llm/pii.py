"""Personal data: fixed patterns, and identifiers learned from their context.

The fixed patterns find seeds. Words around a seed, whatever its kind and form, make lexical
patterns: two or three before it ("me at _"), two after it ("_ is mine") or one on either side
("at _ today"). Other strings with digits in the same place are a pattern's instances, where
they overlap no seed. Patterns and instances form a graph over the whole corpus, which is
scored in rounds until no pattern is added: a pattern is as good as the instances it picks, an
instance as good as its best pattern. Instances of patterns with high confidence, seen in
several texts, are new identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

KINDS = ("email", "ip", "card", "phone", "context")
#: A pattern needs this many different good instances, seeds in this many texts, and this share of good instances.
SUPPORT = 5
TEXTS = 3
CONFIDENCE = 0.8
#: The fewest digits of an instance that is no seed.
DIGITS = 4

# What each kind looks like. A match begins where the one before ended, or where no
# character of its kind comes before it: other places give the same or no match.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?+[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PATTERNS = (_EMAIL, _IP, _CARD, _PHONE)
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: A phone number, or a string of identifier characters with a digit.
_CANDIDATE = _PHONE + r"|(?<![A-Za-z0-9._%+@-])[A-Za-z._%+@-]*+[0-9][A-Za-z0-9._%+@-]*+"
#: The words right before and after it, on the same line.
_BEFORE = r"(?:[A-Za-z][A-Za-z']*+[\x20:=#.,]++){%d}$"
_AFTER = r"^(?:[\x20:=#.,]++[A-Za-z][A-Za-z']*+){%d}"
#: (words before, words after) of each form of pattern.
FORMS = ((3, 0), (2, 0), (0, 2), (1, 1))
_AROUND_CHARS = 200


def _luhn(digits: Column) -> Column:
    """Whether the check sum of a string of digits is right."""
    n = F.length(digits)

    def worth(at: Column) -> Column:
        digit = F.substring(digits, n - at, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(at % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def _stands(kind: Column, value: Column) -> Column:
    """Whether a match of a fixed pattern passes the check of its kind."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
        .when(kind == 2, F.when(n.between(13, 19), _luhn(digits)).otherwise(F.lit(False)))
        .when(kind == 3, n.between(9, 15))
        .otherwise(F.lit(True))
    )


def _matched(text: Column, kind: int, pattern: str, hint: Column) -> Column:
    """(kind, pos, gap, value, before, after) of the matches of one pattern; ``gap`` characters lie before each."""
    gaps, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def part(gap: Column, value: Column) -> Column:
        before = F.substring(gap, -_AROUND_CHARS, _AROUND_CHARS)
        return F.struct(F.lit(kind).alias("kind"), F.length(gap).alias("gap"), value.alias("value"), before.alias("before"))

    def followed(match: Column, gap: Column) -> Column:
        return match.withField("after", F.substring(gap, 1, _AROUND_CHARS))

    # One gap more than values: the rest of the text, which zip_with pairs with null.
    found = F.filter(F.zip_with(gaps, values, part), lambda p: p["value"].isNotNull())
    found = F.zip_with(found, F.slice(gaps, 2, F.greatest(F.size(values), F.lit(0))), followed)
    placed = F.transform(found, lambda p, at: p.withField("pos", at))
    return F.when(hint, placed).otherwise(F.array().cast(_MATCH))


_MATCH = "array<struct<kind: int, gap: int, value: string, before: string, after: string, pos: int>>"


def found_matches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end, value, before, after): matches of all patterns and of candidates, with their places."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    at_sign, plus, digit = F.contains("text", F.lit("@")), F.contains("text", F.lit("+")), F.col("text").rlike("[0-9]")
    hints = (at_sign, digit, digit, plus & digit, digit)
    kinds = [_matched(F.col("text"), k, p, h) for k, (p, h) in enumerate(zip((*_PATTERNS, _CANDIDATE), hints, strict=True))]
    parts = (
        keyed.where(at_sign | digit)
        .select("doc_id", "text_hash", F.inline(F.concat(*kinds)))
        .distinct()  # rows that repeat id and text
    )
    order = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(order)
    return parts.withColumn("end", end).select(
        "doc_id", "text_hash", "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value", "before", "after"
    )


def apart(found: DataFrame) -> DataFrame:
    """The candidates among matches, without dots at their end, that overlap no match of a fixed pattern."""
    dots = F.length("value") - F.length(F.regexp_replace("value", r"\.+$", ""))
    candidate = F.col("kind") == len(_PATTERNS)
    trimmed = found.withColumn("_dots", F.when(candidate, dots).otherwise(0)).select(
        "doc_id", "text_hash", "kind", "start", (F.col("end") - F.col("_dots")).alias("end"),
        F.expr("substring(value, 1, length(value) - _dots)").alias("value"), "before",
        F.expr("right(value, _dots) || after").alias("after"),
    )
    of_text = Window.partitionBy("doc_id", "text_hash")
    # Spans that begin at the same place are peers, so each sees the others.
    up_to = of_text.orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    on_from = of_text.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.max(F.when(~candidate, F.col("end"))).over(up_to)
    next_start = F.min(F.when(~candidate, F.col("start"))).over(on_from)
    free = (F.coalesce("_reached", F.lit(-1)) <= F.col("start")) & (F.coalesce("_next", F.col("end")) >= F.col("end"))
    return trimmed.withColumn("_reached", reached).withColumn("_next", next_start).where(candidate & free).drop("_reached", "_next")


def contexts(matches: DataFrame) -> DataFrame:
    """Matches once for each form of ``pattern`` that the words around them fill, in lower case."""

    def words(text: str, form: str, n: int) -> Column:
        """``n`` words of a side, null if there are fewer; no words are an empty string."""
        if not n:
            return F.lit("")
        return F.nullif(F.trim(F.lower(F.regexp_replace(F.regexp_extract(text, form % n, 0), r"[\x20:=#.,]+", " "))), F.lit(""))

    forms = [F.concat(words("before", _BEFORE, b), F.lit(" _ "), words("after", _AFTER, a)) for b, a in FORMS]
    around = matches.withColumn("pattern", F.explode(F.array_compact(F.array(*forms))))
    return around.drop("before", "after")


def pattern_edges(seeds: DataFrame, candidates: DataFrame, texts: int = TEXTS) -> DataFrame:
    """(pattern, value) of the patterns that can matter: those of a candidate, with seeds in at least ``texts`` texts.

    Both tables have (pattern, value, text_hash). Only words, values and hashes are shuffled, and each
    pattern is counted by part before it meets its other parts.
    """
    likely = seeds.join(candidates.select("pattern").distinct(), "pattern", "left_semi")
    wide = likely.select("pattern", "text_hash").distinct().groupBy("pattern").count().where(F.col("count") >= texts)
    edges = seeds.select("pattern", "value").unionByName(candidates.select("pattern", "value"))
    return edges.join(wide.select("pattern"), "pattern", "left_semi").distinct()


def confident_patterns(edges: DataFrame, seeds: DataFrame, rounds: int | None = None) -> DataFrame:
    """(pattern, confidence) of the patterns that pick mostly good instances.

    ``edges`` has (pattern, value), ``seeds`` has (value); both without repetition. Rounds end
    when one adds no pattern: scores never fall from round to round, so patterns only come in.
    ``rounds`` ends them earlier.
    """
    good = seeds.select("value", F.lit(1.0).alias("score"))
    known = 0
    while True:
        score = F.coalesce("score", F.lit(0.0))
        patterns = (
            edges.join(good, "value", "left")
            .groupBy("pattern")
            .agg(F.avg(score).alias("confidence"), F.sum(score).alias("support"))
            .where((F.col("confidence") >= CONFIDENCE) & (F.col("support") >= SUPPORT))
            .select("pattern", "confidence")
        )
        patterns = stored(patterns, "patterns")
        before, known = known, patterns.count()
        if rounds is not None:
            rounds -= 1
        if known == before or rounds == 0:
            return patterns
        picked = edges.join(patterns, "pattern").select("value", F.col("confidence").alias("score"))
        both = seeds.select("value", F.lit(1.0).alias("score")).unionByName(picked)
        good = both.groupBy("value").agg(F.max("score").alias("score"))


def personal_data(docs: DataFrame, rounds: int | None = None) -> DataFrame:
    """(doc_id, text_hash, base, added), one row for each row of ``docs``.

    ``base`` and ``added`` are arrays of (kind, start, end) in code points, end exclusive, in
    order; ``kind`` is an index into ``KINDS``. ``base`` has the matches of the fixed patterns
    that pass the checks of their kind, ``added`` the instances of confident contexts that
    overlap none of them. A null or empty text has none; null and repeated ids stay as they are, and
    equal rows are treated alike. Other columns are ignored. An empty table gives no rows.
    ``rounds`` limits how often patterns and instances are scored; none means until no pattern is added.
    """
    found = stored(found_matches(docs).where(_stands(F.col("kind"), F.col("value"))), "pii-matches")
    base = found.where(F.col("kind") < len(_PATTERNS))
    enough = F.length(F.regexp_replace("value", "[^0-9]", "")) >= DIGITS
    candidates = stored(contexts(apart(found).where(enough)), "pii-candidates")
    seeds = base.select("value").distinct()
    edges = stored(pattern_edges(contexts(base), candidates), "pii-edges")
    patterns = confident_patterns(edges, seeds, rounds)
    added = candidates.join(patterns.select("pattern"), "pattern", "left_semi").drop("pattern").distinct()

    columns = ["doc_id", "text_hash", "kind", "start", "end"]
    spans = base.select(columns).unionByName(added.select(columns))
    span = F.struct("kind", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    of_doc = (
        spans.groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set(span)).alias("spans"))
        .select(F.col("doc_id").alias("_key"), F.col("text_hash").alias("_hash"), "spans")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    none = F.array().cast("array<struct<kind: int, start: bigint, end: bigint>>")
    all_spans = F.coalesce("spans", none)
    same = rows["doc_id"].eqNullSafe(of_doc["_key"]) & (rows["text_hash"] == of_doc["_hash"])
    return rows.join(of_doc, same, "left").select(
        "doc_id",
        "text_hash",
        F.filter(all_spans, lambda s: s["kind"] < len(_PATTERNS)).alias("base"),
        F.filter(all_spans, lambda s: s["kind"] == len(_PATTERNS)).alias("added"),
    )
