"""Personal data found by pattern, and terms that disclose it found by co-occurrence.

Base spans are e-mail addresses, IP addresses, payment card numbers and phone
numbers. Each distinct value is a protected entity. Over all lines of the
corpus, a term (a run of letters and digits) is measured against every entity
that shares a line with it: the pointwise mutual information of the two, as a
share of all the information the entity carries,

    log(n_both * N / (n_term * n_entity)) / log(N / n_entity).

A share of 1 means the term never occurs without the entity. Terms whose share
reaches ``DISCLOSES_FROM`` are generalised to their kind, from ``REMOVED_FROM``
removed, wherever they occur, however many terms an entity has. One line says
nothing, as all its words always meet its entities, and a copied line is one
line: the two must meet in ``LEAST_CONTEXTS`` different contexts. Lines of an
entity whose words are the entity's common words (those of more than half of
its lines) to at least ``COPIED`` percent are copies of each other and one context.

All of it is DataFrame functions. No pattern crosses a line end, so spans can
be worked out per text and entities per line. The patterns never go back over
what they have read, so time stays proportional to a text's length.

Defined cases: null text is empty; rows with one ``doc_id`` share their terms;
a null ``doc_id`` is a document like another; repeated lines count in N as often
as they occur and once as a context; an empty table gives an empty result;
further columns are carried along by :func:`sanitised` and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardlight.session import settled

DISCLOSES_FROM, REMOVED_FROM = 0.8, 0.95
# Different contexts of an entity and a term, and common words of a copied line in percent.
LEAST_CONTEXTS, COPIED = 2, 80

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
_LABEL = r"[A-Za-z0-9-]"
# A run that a match may begin in is tried at its start only (or right behind the last match):
# from any later start it would end, or fail, at the same place.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Something every match holds, quick to look for.
_HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
          "card": r"[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]"}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_IP = rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"
_SPAN = "struct<start:int,end:int,value:string>"
TERM = r"[\p{L}\p{N}]+"
_BREAK = r"[^\p{L}\p{N}]+"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    values = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether a match of a kind's pattern is one of the kind."""
    if kind == "ip":
        return value.rlike(_IP)
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        # The length decides first, so no endless run of digits is summed.
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def located(text: Column, pattern: str, wanted) -> Column:
    """Matches of a pattern with their places, as far as ``wanted`` (of a span) says so.

    What stands between the matches gives their places: its lengths and theirs are
    added up by doubling steps, so that time stays near proportional to the matches.
    """
    gaps = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(gaps.alias("gap"), values.alias("value"))
    lengths = F.transform(pairs, lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["value"]), F.lit(0)))
    ends = F.transform(F.arrays_zip(running_sums(lengths).alias("end"), values.alias("value")), lambda p: F.struct(
        (p["end"] - F.length(p["value"])).alias("start"), p["end"].alias("end"), p["value"].alias("value")))
    return F.filter(ends, lambda span: span["value"].isNotNull() & wanted(span))


def running_sums(numbers: Column) -> Column:
    """The sum up to each element, in as many passes as the length has binary digits."""
    passes = F.sequence(F.lit(0), F.ceil(F.log2(F.size(numbers) + 1)).cast("int"))
    return F.aggregate(passes, numbers, lambda sums, k: F.transform(
        sums, lambda x, i: x + F.coalesce(F.get(sums, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0))))


def base_spans(text: Column, kind: str) -> Column:
    """All spans of a kind, leftmost first and never overlapping."""
    found = located(text, PATTERNS[kind], lambda span: valid(kind, span["value"]))
    return F.when(text.rlike(_HINTS[kind]), found).otherwise(
        F.array().cast(f"array<{_SPAN}>"))


def entity_lines(docs: DataFrame) -> DataFrame:
    """Every line with an entity, by its hash: ``entities`` and other ``terms`` of it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    some = F.lit(False)
    for kind in KINDS:
        some = some | F.col("line").rlike(_HINTS[kind])
    lines = docs.select(F.explode(F.split(text, "\n")).alias("line")).where(some)
    values = [_values(kind) for kind in KINDS]
    bare = F.col("line")
    for kind in KINDS:
        bare = F.regexp_replace(bare, PATTERNS[kind], " ")
    return (lines.withColumn("entities", F.array_distinct(F.concat(*values)))
            .where(F.size("entities") > 0)
            .select(F.xxhash64("line").alias("line_hash"), "entities",
                    line_terms(bare).alias("terms")))


def _values(kind: str) -> Column:
    return F.transform(base_spans(F.col("line"), kind),
                       lambda span: F.concat(F.lit(kind + ":"), F.lower(span["value"])))


def line_terms(line: Column) -> Column:
    """Distinct terms of a line, lower-cased."""
    return F.array_remove(F.array_distinct(F.split(F.lower(line), _BREAK)), "")


def disclosing_terms(docs: DataFrame) -> DataFrame:
    """Terms that disclose an entity, with the largest ``share`` over entities.

    Pairs arise only in lines with an entity and are combined before they are
    shuffled. The whole corpus is read once for the counts of the terms that
    meet an entity often enough. Counts are written to the shared folder, so
    that the planner knows how many there are.
    """
    lines = settled(entity_lines(docs), "entity-lines")
    entities = lines.select(F.explode("entities").alias("entity")).groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_entity"))
    pairs = lines.select("line_hash", F.explode("entities").alias("entity"), "terms").select(
        "line_hash", "entity", F.explode("terms").alias("term"))
    pairs = settled(pairs.groupBy("entity", "term", "line_hash").agg(F.count(F.lit(1)).alias("n")), "entity-pairs")
    met = settled(
        pairs.groupBy("entity", "term").agg(F.sum("n").alias("n_both"))
        .join(_contexts(pairs).where(F.col("contexts") >= LEAST_CONTEXTS), ["entity", "term"])
        .join(entities, "entity").select("entity", "term", "n_both", "n_entity"), "entity-terms")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    every = docs.select(F.explode(F.split(text, "\n")).alias("line"))
    asked = met.select("term").distinct()
    seen = (every.select(F.explode(line_terms(F.col("line"))).alias("term"))
            .join(asked, "term", "left_semi")
            .groupBy("term").agg(F.count(F.lit(1)).alias("n_term")))
    total = docs.agg(F.sum(
        F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)).first()[0]
    n_lines = F.lit(float(total or 0))
    shares = (met.join(seen, "term")
              .withColumn("share", F.log(F.col("n_both") * n_lines
                                         / (F.col("n_term") * F.col("n_entity")))
                          / F.log(n_lines / F.col("n_entity")))
              .where((n_lines > F.col("n_entity")) & (F.col("share") >= DISCLOSES_FROM)))
    return shares.groupBy("term").agg(F.max("share").alias("share"))


def _contexts(pairs: DataFrame) -> DataFrame:
    """Different contexts of each (``entity``, ``term``) that meets in two lines or more.

    ``pairs`` has a row per entity, term and different line. Copies of a line, a few words apart,
    are one context; an entity that stands in one line only has none to tell.
    """
    several = pairs.groupBy("entity", "line_hash").agg(F.count(F.lit(1)).alias("size")).groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_lines")).where(F.col("n_lines") > 1)
    some = pairs.join(several, "entity")
    held = settled(some.groupBy("entity", "term", "n_lines").agg(F.count(F.lit(1)).alias("n_held"))
                   .where(F.col("n_held") > 1), "entity-held")
    common = held.where(2 * F.col("n_held") > F.col("n_lines")).select("entity", "term", F.lit(1).alias("common"))
    copied = (some.join(common, ["entity", "term"], "left").groupBy("entity", "line_hash")
              .agg((100 * F.count("common") >= COPIED * F.count(F.lit(1))).alias("copied")))
    return (some.join(held.select("entity", "term"), ["entity", "term"], "left_semi")
            .join(copied, ["entity", "line_hash"]).groupBy("entity", "term")
            .agg((F.count_if(~F.col("copied")) + F.max(F.col("copied").cast("int"))).alias("contexts")))


def spans_of(docs: DataFrame) -> DataFrame:
    """``docs`` whole in ``pii_row``, with ``pii_doc``, ``pii_text``, an array of spans per kind,
    and ``term`` spans with what becomes of them.

    The terms of all texts meet the disclosing ones; only documents with such a
    term have their words located. The documents found are written to the shared
    folder, so texts are shuffled only if there are too many to broadcast.
    """
    disclosing = settled(disclosing_terms(docs), "disclosing-terms")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("bigint")
    hits = settled(
        docs.select(doc.alias("h_doc"), F.explode(line_terms(text)).alias("term"))
        .join(disclosing, "term").groupBy("h_doc")
        .agg(F.map_from_entries(F.collect_set(F.struct("term", "share"))).alias("h_terms")),
        "disclosing-hits")
    rows = docs.select(F.struct("*").alias("pii_row"), doc.alias("pii_doc"),
                       text.alias("pii_text"))
    rows = rows.join(hits, F.col("pii_doc").eqNullSafe(F.col("h_doc")), "left").drop("h_doc")
    rows = rows.withColumns({kind: base_spans(F.col("pii_text"), kind) for kind in KINDS})
    base = F.concat(*KINDS)

    def free(span):
        apart = ~F.exists(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
        return F.map_contains_key(F.col("h_terms"), F.lower(span["value"])) & apart

    return rows.withColumn("term", F.when(
        F.col("h_terms").isNotNull(), located(F.col("pii_text"), TERM, free)).otherwise(
        F.array().cast(f"array<{_SPAN}>")))


def _written(kind: str) -> Column:
    return F.transform(F.col(kind), lambda s: F.concat_ws(
        ":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def privacy_table(docs: DataFrame) -> DataFrame:
    """Per document: counts by kind, the digest of the base spans, and all spans."""
    spans = spans_of(docs)
    base = F.concat(*(_written(kind) for kind in KINDS))
    return spans.select(
        F.col("pii_doc").alias("doc_id"),
        *(F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, _written("term")), ",").alias("spans"),
        F.size("term").cast("bigint").alias("n_term"))


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced: base spans and weaker terms by their kind, others gone.

    Where spans of different kinds overlap, the one that begins first is replaced.
    """
    spans = spans_of(docs)
    marked = [F.transform(F.col(kind), _marking(F.lit(f"[{kind.upper()}]"))) for kind in KINDS]
    marked.append(F.transform(F.col("term"), _term_marking))
    every = F.sort_array(F.concat(*marked))
    text = F.col("pii_text")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc, span):
        between = F.substring(text, acc["at"] + 1, span["start"] - acc["at"])
        return F.when(span["start"] >= acc["at"], F.struct(
            span["end"].alias("at"),
            F.concat(acc["parts"], F.array(between, span["mark"])).alias("parts"))).otherwise(acc)

    folded = F.aggregate(every, start, step)
    rest = F.substring(text, folded["at"] + 1, F.length(text))
    clean = F.concat(F.array_join(folded["parts"], ""), rest)
    return spans.select(*(
        F.when(F.col("pii_row.text").isNotNull(), clean).alias(c) if c == "text"
        else F.col(f"pii_row.`{c}`").alias(c) for c in docs.columns))


def _marking(mark: Column):
    return lambda span: F.struct(span["start"].alias("start"), span["end"].alias("end"),
                                 mark.alias("mark"))


def _term_marking(span: Column) -> Column:
    share = F.element_at(F.col("h_terms"), F.lower(span["value"]))
    general = F.when(span["value"].rlike("^[0-9]+$"), F.lit("[NUMBER]")).otherwise(
        F.lit("[TERM]"))
    return F.struct(span["start"].alias("start"), span["end"].alias("end"),
                    F.when(share >= REMOVED_FROM, F.lit("")).otherwise(general).alias("mark"))
